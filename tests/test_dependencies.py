"""Dependencies of every kind of file: origins, canonical names, the last declaration, unreadable files and markers."""

from pyspark.sql import functions as F

from lodestone.operators import dependencies as deps

FILES = {
    "requirements.txt": "a>=1\nB_c==2 # why\n#x\n-e .\n\nd; python_version < '3'\ne; python_version >= '3' and sys_platform == 'linux'\nf; odd ~ 'x'\ng @ https://x/y.zip\n  h  \nbad req\n",
    "requirements/z/dev.txt": "a>=5\n",
    "requirements-x.txt": "a>=6\n",
    "notrequirements.txt": "zz\n",
    "environment.yml": "dependencies:\n- 'conda-lib=1.2'\n- other>=3 # c\n- pip:\n  - piped>2\n- after\nchannels:\n- nope\n",
    "environment.yaml": ": [broken",
    "pyproject.toml": "[project]\ndependencies = ['b.C~=3.0']\n[dependency-groups]\nlint = ['ruff', {include-group = 'x'}]\n[build-system]\nrequires = ['hatch']\n",
    "setup.cfg": "[options]\ninstall_requires =\n  cfg1\n  cfg2>1\n",
    "setup.py": "from x import setup\n_deps = ['cat==1']\n_deps2 = ['no']\nx.setup(install_requires=['late', 5, 'cfg1<9'])\nsetup(install_requires=names)\n",
}


def found(spark, files):
    rows = spark.createDataFrame([("r", p, t) for p, t in files.items()], "repository string, path string, text string")
    return {r.canonical: (r.package, r.requirement, r.source, r.scope) for r in deps.dependencies(rows).collect()}


def test_every_kind(spark):
    assert found(spark, FILES) == {
        "a": ("a", ">=1", "requirements.txt", "declared"),
        "b-c": ("b.C", "~=3.0", "pyproject.toml:project.dependencies", "declared"),
        "e": ("e", "", "requirements.txt", "declared"),
        "g": ("g", "", "requirements.txt", "declared"),
        "h": ("h", "", "requirements.txt", "declared"),
        "conda-lib": ("conda-lib", "==1.2", "environment.yml", "declared"),
        "other": ("other", ">=3", "environment.yml", "declared"),
        "piped": ("piped", ">2", "environment.yml:pip", "declared"),
        "after": ("after", "", "environment.yml", "declared"),
        "ruff": ("ruff", "", "pyproject.toml:dependency-groups.lint", "development"),
        "hatch": ("hatch", "", "pyproject.toml:build-system.requires", "build"),
        "cfg1": ("cfg1", "<9", "setup.py:setup.install_requires", "declared"),
        "cfg2": ("cfg2", ">1", "setup.cfg:options.install_requires", "declared"),
        "cat": ("cat", "==1", "setup.py:_deps", "catalog"),
        "late": ("late", "", "setup.py:setup.install_requires", "declared"),
    }


def test_lists_go_by_folders(spark):
    assert found(spark, {p: FILES[p] for p in ("requirements/z/dev.txt", "requirements-x.txt")})["a"][1] == ">=6"


def test_broken_and_missing_files(spark):
    broken = {p: "\0[x = " for p in FILES} | {"setup.py": None}
    assert found(spark, broken) == {} and found(spark, {"requirements.txt": None}) == {}


def test_markers(spark):
    texts = ["x", "x; python_version > '3.9'", "x; python_version < '3.9'", "x; extra == 'a'", "x; os_name != 'nt' and python_version == '3.*'", "x; os_name == 'nt' or sys_platform in 'linux darwin'", "x; (a == 'b')", "x;"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", deps.applies(F.col("t")).alias("ok")).orderBy("i").collect()
    assert [r.ok for r in got] == [True, True, False, False, True, True, None, None]


def test_compatibility_takes_the_own_spelling_first(spark):
    rows = spark.createDataFrame([("r", "foo-bar", "Foo_Bar", ">1"), ("r", "x", "x", ""), ("r", "y", "y", "oops"), ("s", "x", "x", ">1")], "repository string, canonical string, package string, requirement string")
    packages = spark.createDataFrame([("e", "Foo_Bar", "1"), ("e", "foo-bar", "2"), ("e", "x", "1"), ("e", "y", "1"), ("f", "x", "3")], "environment string, package string, version string")
    selected = spark.createDataFrame([("r", "e"), ("r", "e"), ("s", "f")], "repository string, environment string")
    got = {(r.repository, r.canonical): (r.environment_version, r.status) for r in deps.compatibility(rows, selected, packages).collect()}
    assert got == {("r", "foo-bar"): ("1", "conflict"), ("r", "x"): ("1", "unknown"), ("r", "y"): ("1", "unknown"), ("s", "x"): ("3", "likely_compatible")}
