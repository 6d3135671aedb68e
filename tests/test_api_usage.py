"""The inventory of used libraries: aliases, order of files, bounds and files that don't parse."""

from lodestone.operators import api_usage

FILES = {
    "a.py": "import numpy as np\nimport os.path\nfrom torch import nn as N, optim\nfrom . import x\nfrom y import *\nclass M(N.Module, Base): pass\nnp.zeros(3, dtype=int)\nN.Linear(1, 2).to('cpu')\nnp.float = 1\nif np.__version__ < '2': pass\nopen('f')\n",
    "a/b.py": "os.getcwd()\nrequests.get('u')\nimport requests\n",
    "z.py": "requests.post(url='u')\nnumpy.ones(1)\nx: int = 1\nself.a: int = np.b.c(*q, **k)\n",
    "0.py": "requests.early()\nimport os\n",
    "bad.py": "def (",
    "none.py": None,
    ".hidden/c.py": "import hidden\n",
    "venv/d.py": "import venved\n",
    "t.txt": "import text\n",
}


def test_inventory(spark):
    rows = api_usage.inventory(spark.createDataFrame([("r", p, t) for p, t in FILES.items()] + [("s", "one.py", "import os\nos.a()")], "repository string, path string, text string")).collect()
    got = {}
    for r in rows:
        if r.repository == "r":
            got.setdefault((r.library, r.kind), []).append((r.nth, r.value) if r.nth else r.value)
    assert {k: sorted(v) for k, v in got.items()} == {
        ("numpy", "imports"): ["numpy"],
        ("numpy", "files"): ["a.py"],
        ("numpy", "symbols"): ["numpy.ones", "numpy.zeros"],
        ("numpy", "call_sites"): [(1, "numpy.zeros"), (2, "numpy.ones")],
        ("numpy", "monkey_patches"): [(1, "numpy.float")],
        ("numpy", "detected_version_assumptions"): [(1, "numpy")],
        ("os", "imports"): ["os", "os.path"],
        ("os", "files"): ["0.py", "a.py"],
        ("os", "symbols"): ["os.getcwd"],
        ("os", "call_sites"): [(1, "os.getcwd")],
        ("torch", "imports"): ["torch.nn", "torch.optim"],
        ("torch", "files"): ["a.py"],
        ("torch", "symbols"): ["torch.nn.Linear"],
        ("torch", "call_sites"): [(1, "torch.nn.Linear")],
        ("torch", "inherited_symbols"): [(1, "torch.nn.Module")],
        ("requests", "imports"): ["requests"],
        ("requests", "files"): ["a/b.py"],
        ("requests", "symbols"): ["requests.get", "requests.post"],
        ("requests", "call_sites"): [(1, "requests.get"), (2, "requests.post")],
    }
    post = next(r for r in rows if r.value == "requests.post" and r.kind == "call_sites")
    assert (post.path, post.line, post.detail) == ("z.py", 1, '{"parameters": ["url"], "positional_arguments": 0}')
    assert [r.value for r in rows if r.repository == "s" and r.kind == "call_sites"] == ["os.a"]


def test_lists_keep_their_first_rows(spark):
    files = [("r", f"f{i:03}.py", "import m\n" + "".join(f"m.c{i}_{j}()\nclass C{j}(m.B{j}): pass\n" for j in range(40))) for i in range(20)]
    rows = api_usage.inventory(spark.createDataFrame(files, "repository string, path string, text string")).collect()
    calls = [r.value for r in sorted((r for r in rows if r.kind == "call_sites"), key=lambda r: r.nth)]
    assert calls == [f"m.c{i}_{j}" for i in range(20) for j in range(40)][:500]
    assert sum(r.kind == "inherited_symbols" for r in rows) == 200 and sum(r.kind == "symbols" for r in rows) == 800


def test_all_files_of_a_repository_are_read(spark):
    files = spark.range(5003).selectExpr("'r' AS repository", "format_string('f%05d.py', id) AS path", "IF(id >= 5000, 'import m', 'import os') AS text")
    rows = api_usage.inventory(files).where("kind = 'files'").groupBy("library").count().collect()
    assert {r.library: r["count"] for r in rows} == {"os": 5000, "m": 3}
