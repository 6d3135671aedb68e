"""File sources and sinks: JSONL manifests with fixed schemas, chunk tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SNAPSHOT = "schema_version int, document_id string, status string, title string, tags array<string>, content_fingerprint string, metadata_fingerprint string, updated_at string"
DELTA = f"schema_version int, sync_id string, operation string, document_id string, previous_fingerprint string, current_fingerprint string, reason string, manifest_record struct<{SNAPSHOT.replace(' ', ':').replace(',:', ',')}>"
CATALOG = "schema_version int, sequence bigint, sync_id string, previous_sync_id string, from_version bigint, target_version bigint, delta_path string, delta_sha256 string, row_count bigint, created_at string"
VERSION = 1


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows of a manifest; malformed ones and unknown versions are errors."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    version = F.when(F.col("schema_version") == VERSION, F.col("schema_version")).otherwise(F.raise_error(F.lit("unknown schema version")).cast("int"))
    return rows.withColumn("schema_version", version)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Ready documents of a snapshot, tags sorted and distinct."""
    return read_jsonl(spark, path, SNAPSHOT).where("status = 'ready'").withColumn("tags", F.array_sort(F.array_distinct("tags")))


def write_jsonl(rows: DataFrame, path: str, key: str) -> None:
    """Rows sorted by a unique key."""
    if rows.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"{key} is not unique")
    rows.orderBy(key).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_chunks(chunks: DataFrame, path: str) -> int:
    """A zstd Parquet table of chunks; its rows are counted while they are written and again from the files."""
    from pyspark.sql import Observation

    seen = Observation()
    chunks.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "zstd").parquet(path)
    found = chunks.sparkSession.read.parquet(path).count()
    if found != seen.get["n"]:
        raise OSError(f"{path} holds {found} rows of {seen.get['n']}")
    return found


def read_deltas(spark: SparkSession, catalog: DataFrame, folder: str) -> DataFrame:
    """(sequence, rows of the delta) of all files of a catalogue (sequence, sync_id, delta_path, row_count). Files that lie outside the folder, rows of
    another sync, unknown operations and files whose number of rows isn't the catalogue's are errors."""
    outside = catalog.where(F.col("delta_path").startswith("/") | F.array_contains(F.split("delta_path", "/"), ".."))
    if outside.limit(1).count():
        raise ValueError("a delta lies outside its folder")
    rows = read_jsonl(spark, f"{folder}/*", DELTA).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    known = catalog.select("sequence", F.col("sync_id").alias("expected"), "row_count", F.element_at(F.split("delta_path", "/"), -1).alias("file"))
    both = known.join(rows, "file", "left")
    counted = both.groupBy("sequence", "row_count").agg(F.count("operation").alias("n"), F.count_if(F.col("sync_id").isNotNull() & ~(F.col("sync_id") == F.col("expected"))).alias("others"), F.count_if(F.col("operation").isNotNull() & ~F.col("operation").isin("upsert", "delete")).alias("unknown"))
    if counted.where("n <> row_count OR others > 0 OR unknown > 0").limit(1).count():
        raise ValueError("a delta file is not what its catalogue says")
    return both.where("operation IS NOT NULL").drop("expected", "row_count", "file")


def append_catalog(catalog: DataFrame, entry: DataFrame) -> DataFrame:
    """The catalogue with one more entry, numbered after its last; a sync that it holds already is an error."""
    if catalog.join(entry.select("sync_id"), "sync_id", "left_semi").limit(1).count():
        raise ValueError("the sync is in the catalogue already")
    last = catalog.agg(F.coalesce(F.max("sequence"), F.lit(0)).alias("last"))  # one row
    return catalog.unionByName(entry.drop("sequence").join(last, F.lit(True)).withColumn("sequence", F.col("last") + 1).drop("last"))


def replace_documents(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The table after the new rows replaced all rows of their documents."""
    return current.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def delta_faults(spark: SparkSession, catalog: DataFrame, folder: str) -> DataFrame:
    """(sequence, fault) of a catalogue's files that aren't what it says: "outside" the folder, "missing", "hash" or "rows", the first that holds. Bytes are read
    once, by file; a file's rows are its lines that aren't blank. Spark's readers pass over empty files, so a file that should be empty isn't missed."""
    parts = F.split("delta_path", "/")
    # a path leaves the folder if, on its way, it goes up more often than down
    depth = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.lit(0).alias("least")), lambda a, p: F.struct((a["at"] + F.when(p == "..", -1).when(p.isin("", "."), 0).otherwise(1)).alias("at"), F.least(a["least"], a["at"] + F.when(p == "..", -1).otherwise(0)).alias("least")), lambda a: a["least"])
    named = catalog.select("sequence", "delta_sha256", "row_count", (F.col("delta_path").startswith("/") | (depth < 0)).alias("outside"), F.array_join(F.filter(parts, lambda p: ~p.isin("", ".")), "/").alias("file"))
    root = F.regexp_replace(F.lit(folder), r"^file:/*|/+$", "")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    lines = F.filter(F.split(F.make_valid_utf8(F.col("content").cast("string")), "\n"), lambda x: F.regexp_replace(x, r"(?U)\s", "") != "")
    # files by the end of their path below the folder
    held = found.select(F.regexp_replace(F.replace(F.regexp_replace("path", r"^file:/*", ""), root, F.lit("")), "^/+", "").alias("file"), F.sha2("content", 256).alias("sha"), F.size(lines).cast("bigint").alias("n"))
    both = named.join(held, "file", "left")
    fault = F.when(F.col("outside"), "outside").when(F.col("sha").isNull(), F.when((F.col("delta_sha256") == F.sha2(F.lit(b""), 256)) & (F.col("row_count") == 0), F.lit(None)).otherwise("missing")).when(F.col("sha") != F.col("delta_sha256"), "hash").when(F.col("n") != F.col("row_count"), "rows")
    return both.select("sequence", fault.alias("fault")).where("fault IS NOT NULL")


#: What files of a repository are read.
SUFFIXES, STARTS = (".py", ".md", ".mdx", ".rst", ".txt"), ("readme", "changelog", "release", "migration")


def _glob(pattern: str) -> str:
    """A glob as a pattern of whole paths: * and ? match slashes too, brackets hold characters or none of them after "!"."""
    out, i = "", 0
    while i < len(pattern):
        c, end = pattern[i], pattern.find("]", i + 2)
        if c == "[" and end > 0:
            inner = pattern[i + 1 : end]
            negated, inner = inner.startswith("!"), inner.removeprefix("!")
            out += "[" + "^" * negated + "".join("\\" + x if x in r"\[]^&" else x for x in inner) + "]"
            i = end
        else:
            out += {"*": ".*", "?": "."}.get(c) or ("\\" + c if c in r".^$+{}()|\[]" else c)
        i += 1
    return f"(?s)^{out}$"


def repository_files(spark: SparkSession, root: str, include: list[str], exclude: list[str], most_bytes: int, most_files: int) -> DataFrame:
    """(path, length, text) of a repository's documents: the first ``most_files`` by path of those that a glob of ``include`` matches and none of ``exclude``, by
    their path below the root or their name alone, of known suffixes or starts and of at most ``most_bytes``. Sizes and names are settled from the listing:
    only the files that stay are read. Bytes that are no UTF-8 become replacement characters."""
    base = F.regexp_replace(F.lit(root), r"^file:/*|/+$", "")
    below = F.regexp_replace(F.replace(F.regexp_replace("path", r"^file:/*", ""), base, F.lit("")), "^/+", "")
    source = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(F.col("length") <= most_bytes)
    name = F.element_at(F.split("below", "/"), -1)
    any_of = lambda globs: F.lit(False) if not globs else F.col("below").rlike("|".join(map(_glob, globs))) | name.rlike("|".join(map(_glob, globs)))
    known = F.lower(name).rlike("(" + "|".join(x.replace(".", r"\.") for x in SUFFIXES) + ")$|^(" + "|".join(STARTS) + ")")
    listed = source.select("path", below.alias("below")).where(any_of(include) & ~any_of(exclude) & known)
    kept = listed.orderBy(F.split("below", "/")).limit(most_files)
    return source.join(kept, "path").select(F.col("below").alias("path"), "length", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))
