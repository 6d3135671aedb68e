"""Parts of texts lose blanks at their ends and nothing else: digits that equal a part's number stay."""

from pyspark.sql import functions as F

from lodestone.functions import code, text
from lodestone.plans import chunking


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()["y"]


def test_sentences_keep_their_digits(spark):
    assert one(spark, "0 a. 121 b 1! 2. c", text.sentences) == ["0 a.", "121 b 1!", "2.", "c"]
    assert one(spark, "a. 1", text.sentences) == ["a.", "1"]
    assert one(spark, "a. 1 however", text.sentence_roles) == ["establish_context", "identify_gap"] and one(spark, "a. 1", text.sentence_roles) == ["establish_context", "summarize_progress"]


def test_paragraphs_keep_their_digits(spark):
    made = one(spark, "0\n 12 a1 \n\n2", lambda c: chunking.paragraphs(c, "\n"))
    assert made == ["0", "12 a1", "2"]
    assert one(spark, "0\n1 b 1", lambda c: chunking.packed(chunking.paragraphs(c, "\n"), 64)) == ["0\n\n1 b 1"]


def test_exceptions_of_logs_lose_blanks(spark):
    log = "Traceback\n  ValueError: got 1"
    row = spark.createDataFrame([(log,)], "x string").select(*code.debug_log(F.col("x"), "/r")).first()
    assert (row["exception"], row["message"]) == ("ValueError", "got 1")


def test_abbreviations_of_the_query_are_its_sqls(spark, tmp_path):
    import duckdb

    from lodestone import catalog
    from lodestone.functions import features

    value = "LA!! AS.HIR!! IS,HKDN AB CD-EF GH"
    spark.createDataFrame([(1, value)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    documents = duckdb.read_parquet(f"{tmp_path}/documents.parquet/*.parquet")  # noqa: F841
    want = duckdb.sql(catalog.ORACLES["f16_paragraph_features"]).fetchall()
    columns = catalog.QUERIES["f16_paragraph_features"](spark, str(tmp_path))
    assert columns.select("abbreviations").first()[0] == want[0][-1] == "LA,AS,IS,AB,CD-EF,GH"
    # the operator keeps the reference's
    kept = spark.createDataFrame([(value,)], "v string").select(*features.paragraph_features(F.col("v"), F.col("v"))).first()
    assert kept["abbreviations"] == ["LA", "AS", "HIR", "IS", "HKDN", "AB", "CD-EF", "GH"]
