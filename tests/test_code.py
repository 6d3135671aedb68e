"""Code, markup, components, clusters and envelopes on hand-made rows."""

import pytest

from lodestone.functions import code, text
from lodestone.operators import checks, clusters, graph, hub, state
from lodestone.plans import evidence


def test_parts_of_long_texts():
    lines = [f"line {i} " + "x" * (i % 40) for i in range(200)]
    made = list(code.parts("\n".join(lines), 300))
    assert "\n".join(p for p, _, _ in made) == "\n".join(lines)
    assert all(len(p) <= 300 for p, _, _ in made)
    assert [(a, b) for _, a, b in made] == [(a, b) for (_, a, b) in made if b >= a] and made[0][1] == 1 and made[-1][2] == 200
    assert all(second[1] == first[2] + 1 for first, second in zip(made, made[1:], strict=False))
    assert list(code.parts("  \n")) == [] and list(code.parts("y" * 900, 300)) == [("y" * 900, 1, 1)]


def test_markup_sections():
    made = list(code.markup_chunks("start\n# A\nx\n### C\ny\n## B\n```py\n# no\n```\nUnder\n=====\nz"))
    assert [(m["section"], m["text"]) for m in made] == [("", "start"), ("A", "# A\nx"), ("A > C", "### C\ny"), ("A > B", "## B\n```py\n# no\n```"), ("A > Under", "Under\n=====\nz")]


def test_python_chunks_without_definitions():
    assert [(c["symbol_type"], c["text"]) for c in code.python_chunks("x = 1\ny = 2", "m.py")] == [("module", "x = 1\ny = 2")]
    assert [c["symbol_type"] for c in code.python_chunks("def f(:\n", "m.py")] == ["module"]
    assert list(code.python_chunks("", "m.py")) == []


def test_symbols():
    got = code.symbols("import a.b as c\nfrom . import d\n\nMAX = 1\nclass X(Base, m.Other):\n    @property\n    def p(self):\n        return c.run(len(self))\n    async def q(self): pass\n", "pkg/mod.py")
    assert [(s["name"], s["kind"], s["relations"]) for s in got] == [
        ("pkg.mod.c", "import", [("imports", "a.b")]), ("pkg.mod.d", "import", [("imports", "..d")]), ("pkg.mod.MAX", "constant", []),
        ("pkg.mod.X", "class", [("inherits", "Base"), ("inherits", "m.Other")]), ("pkg.mod.X.p", "property", [("calls", "c.run"), ("calls", "len")]), ("pkg.mod.X.q", "method", []),
    ]


def test_credentials_and_secrets(spark):
    df = spark.createDataFrame([("see https://me:pw@host/x?key=abc and tok123, tok1",)], "t string")
    assert df.select(text.without_credentials(df.t)).first()[0] == "see https://<redacted>@host/x?key=abc and tok123, tok1"
    assert df.select(text.without_secrets(df.t, ["tok1", "tok123", ""])).first()[0] == "see https://me:pw@host/x?key=[REDACTED] and [REDACTED], [REDACTED]"


def test_profile_terms(spark):
    df = spark.createDataFrame([("Well-known method, this ABC abcd 神经网络 图 abcd9",)], "t string")
    assert df.select(text.profile_terms(df.t)).first()[0] == ["well-known", "abcd", "神经", "经网", "网络"]


def test_clusters_by_brute_force(spark):
    import hashlib
    import random

    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, "a" if i % 3 else "b", "") for i in range(6)]
    for i in range(6, 90):
        own = list(base) if i % 2 else [f"v{rng.randrange(40)}" for _ in range(rng.randint(1, 30))]
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(5)}"
        rows.append((i, "a" if i % 3 else "b", " ".join(own)))
    rows += [(200, "a", rows[7][2]), (201, "a", "one two"), (202, "b", "One, TWO!"), (203, "a", "one  two")]
    sets = {}
    for i, g, t in rows:
        w = t.lower().replace(",", " ").replace("!", " ").split()
        sets[i] = (g, {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    name = {i: i for i in sets}
    for i in sets:
        for j in sets:
            (g, a), (h, b) = sets[i], sets[j]
            if g == h and (not a and not b or a | b and len(a & b) >= 0.85 * len(a | b)):
                old, new = name[j], name[i]
                name = {k: new if v == old else v for k, v in name.items()}
    members = {}
    for i, v in name.items():
        members.setdefault(v, []).append(str(i))
    want = {i: "cluster:" + hashlib.sha256(('["' + '","'.join(sorted(members[name[i]])) + '"]').encode()).hexdigest() for i in sets}
    from pyspark.sql import functions as F

    got = clusters.clusters(spark.createDataFrame(rows, "id int, g string, t string"), "id", F.col("t"), ["g"]).collect()
    assert {int(r.id): r.cluster for r in got} == want


def test_graph_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.name for r in graph.components(spark.createDataFrame(links, "a int, b int")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 103: 100}


def test_envelope_cuts_and_ends(spark):
    rows = [(1, 1, "one two three"), (1, 2, ""), (1, 3, "four five six seven eight"), (1, 4, "nine"), (2, 1, "a" * 400), (2, 2, "b")]
    got = evidence.envelope(spark.createDataFrame(rows, "q int, rank int, content string"), "q", 10, 6).collect()
    assert [(r.q, r["rank"], r.content, r.tokens, r.truncated) for r in sorted(got, key=lambda r: (r.q, r["rank"]))] == [(1, 1, "one two three", 4, False), (1, 3, "four fiv", 2, True), (2, 1, "a" * 24, 6, True)]


def test_repeated_segments(spark):
    df = spark.createDataFrame([("This is it. this  is it! Other words here. THIS IS IT?",), ("short. short.",), (None,)], "t string")
    assert [r[0] for r in df.select(checks.repeated_segments(df.t)).collect()] == [3, 0, 0]


def test_issue_gate(spark):
    hits = spark.createDataFrame([("issue",), ("tutorial",)], "source_type string")
    assert hub.without_issues(hits, True)[0].count() == 2 and hub.without_issues(hits, False)[1] == ["issue_evidence_filtered"]
    with pytest.raises(PermissionError):
        hub.without_issues(hits, False, True)


def test_full_fetch(spark):
    remote, local = spark.createDataFrame([(1, 1), (2, 2)], "k int, version int"), spark.createDataFrame([(1, 1, False), (2, 2, False)], "k int, version int, deleted boolean")
    assert state.to_fetch(remote, local, "k").count() == 0 and state.to_fetch(remote, local, "k", full=True).count() == 2
