"""Versions and requirements as Columns: keys that sort versions, and specifiers as clauses over those keys.

A key is (epoch, release without zeros at its end, early, number, post, dev): early is -1 for releases under development only, 0, 1 and 2 for alpha, beta
and candidate releases, 3 for releases; post is -1 without one; dev is LAST without one. Structs compare field by field, so keys sort as versions do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LAST = 1 << 62
#: Fixed value: the grammar of versions, by groups: epoch, release, early name, early number, post number, post named, dev, local.
VERSION = r"(?i)^\s*v?(?:(\d+)!)?(\d+(?:\.\d+)*)(?:[-_.]?(alpha|a|beta|b|preview|pre|c|rc)[-_.]?(\d*))?((?:-(\d+))|(?:[-_.]?(?:post|rev|r)[-_.]?(\d*)))?([-_.]?dev[-_.]?(\d*))?(?:\+([a-z0-9]+(?:[-_.][a-z0-9]+)*))?\s*$"
CLAUSE = r"^(===|==|~=|!=|<=|>=|<|>)\s*([^\s=<>~]\S*)$"
#: Fixed value: the start of a requirement: a name, perhaps extras, then clauses in parentheses or not.
REQUIREMENT = r"^\s*([A-Za-z0-9](?:[A-Za-z0-9._-]*[A-Za-z0-9])?)\s*(?:\[([A-Za-z0-9._,\s-]*)\])?\s*(?:@[^;]+|\(([^()]*)\)|([^;@()]*))\s*(?:;.*)?$"


def _n(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("0")).cast("bigint")


def version_key(value: Column) -> Column:
    """The key of a version, null for what is none. Numbers beyond 18 digits are no versions here."""
    g = lambda i: F.regexp_extract(value, VERSION, i)
    numbers = F.transform(F.split(g(2), r"\."), lambda p: p.cast("bigint"))
    last = F.coalesce(F.array_max(F.transform(numbers, lambda n, i: F.when(n != 0, i + 1).otherwise(0))), F.lit(0))
    release = F.slice(numbers, F.lit(1), F.greatest(last, F.lit(1)))
    name, dev, post = F.lower(g(3)), g(8) != "", g(5) != ""
    early = F.when(name.isin("a", "alpha"), 0).when(name.isin("b", "beta"), 1).when(name != "", 2).when(dev & ~post, -1).otherwise(3)
    key = F.struct(
        _n(g(1)).alias("epoch"),
        release.alias("release"),
        early.alias("early"),
        F.when(name != "", _n(g(4))).otherwise(0).alias("number"),
        F.when(post, _n(F.coalesce(F.nullif(g(6), F.lit("")), g(7)))).otherwise(-1).alias("post"),
        F.when(dev, _n(g(9))).otherwise(F.lit(LAST)).alias("dev"),
    )
    return F.when(value.rlike(VERSION) & ~value.rlike(r"\d{19}"), key)


def prerelease(key: Column) -> Column:
    return (key["early"] < 3) | (key["dev"] < LAST)


def canonical_name(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, "[-_.]+", "-"))


def requirement(value: Column) -> list[Column]:
    """(package, specifier) of a requirement's text; null if it is none. The specifier's clauses are in order of their texts, without blanks."""
    ok = value.rlike(REQUIREMENT)
    body = F.concat(F.regexp_extract(value, REQUIREMENT, 3), F.regexp_extract(value, REQUIREMENT, 4))
    parts = F.filter(F.transform(F.split(body, ","), lambda c: F.regexp_replace(c, r"\s+", "")), lambda c: c != "")
    ok &= F.forall(parts, lambda c: c.rlike(CLAUSE))
    return [F.when(ok, F.regexp_extract(value, REQUIREMENT, 1)).alias("package"), F.when(ok, F.array_join(F.array_sort(F.array_distinct(parts)), ",")).alias("requirement")]


def clauses(specifier: Column) -> Column:
    """The specifier's clauses as structs: op, text, prefix (of ".*"), key, parts (the release as written)."""
    written = F.filter(F.transform(F.split(specifier, ","), lambda c: F.trim(c)), lambda c: c != "")

    def read(c: Column) -> Column:
        text = F.regexp_extract(c, CLAUSE, 2)
        bare = F.regexp_replace(text, r"\.\*$", "")
        release = F.transform(F.split(F.regexp_extract(bare, VERSION, 2), r"\."), lambda p: F.nullif(p, F.lit("")).cast("bigint"))
        return F.struct(F.regexp_extract(c, CLAUSE, 1).alias("op"), text.alias("text"), text.endswith(".*").alias("prefix"), version_key(bare).alias("key"), release.alias("parts"), (F.regexp_extract(bare, VERSION, 10) != "").alias("local"))

    return F.transform(written, read)


def _starts(version: Column, parts: Column) -> Column:
    """Whether a version's release, filled up with zeros, starts with the parts."""
    release = F.concat(version["release"], F.array_repeat(F.lit(0).cast("bigint"), F.size(parts)))
    return F.slice(release, F.lit(1), F.size(parts)) == parts


def satisfied(version: Column, c: Column) -> Column:
    """Whether the key of a version without a local part meets a clause; null where the clause can't be read."""
    key, same = c["key"], version == c["key"]
    base = lambda k: F.struct(k["epoch"].alias("epoch"), k["release"].alias("release"))
    under = (version["epoch"] == key["epoch"]) & _starts(version, c["parts"])
    kin = base(version) == base(key)
    # compatible: at least the clause's version, and with its parts but the last
    near = (version >= key) & (version["epoch"] == key["epoch"]) & _starts(version, F.slice(c["parts"], F.lit(1), F.greatest(F.size(c["parts"]) - 1, F.lit(1))))
    less = (version < key) & ~(kin & prerelease(version) & ~prerelease(key))
    own = lambda k: F.struct(*(k[c].alias(c) for c in ("epoch", "release", "early", "number")))
    more = (version > key) & ~((own(version) == own(key)) & (version["post"] >= 0) & (key["post"] < 0))
    return (
        F.when(key.isNull(), F.lit(None).cast("boolean"))
        .when(c["op"].isin("==", "!="), (F.when(c["prefix"], under).otherwise(same & ~c["local"])) == (c["op"] == "=="))
        .when(c["prefix"] | (c["local"] & (c["op"] != "===")), F.lit(None).cast("boolean"))
        .when(c["op"] == "~=", F.when(F.size(c["parts"]) > 1, near))
        .when(c["op"] == "<=", version <= key)
        .when(c["op"] == ">=", version >= key)
        .when(c["op"] == "<", less)
        .when(c["op"] == ">", more)
    )


def contains(version: Column, specifier: Column, early: bool = True) -> Column:
    """Whether a version lies in a specifier: it meets all clauses. Null where either can't be read. Versions before their release are taken as they are if
    ``early``, as the newer rule for a single version says; else only where a clause names such a version. Local parts ("+...") are left out, "===" compares
    texts. Both: plain columns."""
    plain = F.regexp_replace(F.trim(version), r"\+.*$", "")
    bound = F.array(F.struct(version_key(plain).alias("v"), clauses(specifier).alias("cs")))

    def judged(x: Column) -> Column:
        met = lambda c: F.when(c["op"] == "===", F.lower(c["text"]) == F.lower(plain)).otherwise(satisfied(x["v"], c))
        all_met = F.forall(x["cs"], met)
        if not early:
            named = F.exists(x["cs"], lambda c: F.coalesce(prerelease(c["key"]), F.lit(False)) & ~c["op"].isin("!=", "===", "<", ">") & ~c["prefix"])
            all_met &= ~prerelease(x["v"]) | named
        return F.when(x["v"].isNotNull() & ~F.exists(x["cs"], lambda c: met(c).isNull()), all_met)

    return F.get(F.transform(bound, judged), F.lit(0))
