"""Chunks of code documents: what each kind of cut knows, merged metadata, fingerprints and ids."""

import hashlib
import json
import uuid

from lodestone.plans import code_documents as docs

PY = "import os\nfrom a import b\n\nclass C(b):\n    x = 1\n\n    def m(self):\n        return os\n\ndef f():\n    pass  # deprecated\n"
ROWS = [
    ("p", "source_code", "pkg/m.py", PY, '{"library": "lib", "symbol": "old"}'),
    ("s", "source_code", "bad.py", "def (", None),
    ("n", "source_code", "const.py", "X = 1\n", "{}"),
    ("r", "release_note", None, "# 1.0\nIntro\n## Fixes\nA bug fix\n### Breaking\nGone", '{"tag": "v1"}'),
    ("m", "tutorial", "a.md", "no heading\n" + "\n".join("line %d " % i + "x" * 90 for i in range(100)), "{}"),
    ("e", "example", "e.md", " \n ", "{}"),
    ("z", "example", "e.md", None, "{}"),
]


def test_chunks(spark):
    rows = [(i, kind, path, f"url/{i}", f"title {i}", body, meta) for i, kind, path, body, meta in ROWS]
    found = docs.chunks(spark.createDataFrame(rows, "document_id string, source_type string, path string, source_url string, title string, content string, metadata string")).orderBy("document_id", "chunk_index").collect()
    got = {}
    for r in found:
        meta = json.loads(r.metadata)
        identity = {"document_id": r.document_id, "index": r.chunk_index, "processor": docs.PROCESSOR, "metadata": meta, "text": r.text}
        if r.document_id != "m":
            assert r.chunk_fingerprint == hashlib.sha256(json.dumps(identity, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
        assert r.chunk_id == str(uuid.uuid5(docs.NAMESPACE, f"{r.document_id}\0{r.chunk_index}\0{r.chunk_fingerprint}")) and r.text_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
        assert (meta.pop("knowledge_base"), meta.pop("source_url"), meta.pop("title")) == ("code", f"url/{r.document_id}", f"title {r.document_id}")
        got.setdefault(r.document_id, []).append(meta)
    assert got["p"] == [
        {"library": "lib", "module": "pkg.m", "symbol": "pkg.m.C", "symbol_type": "class", "parent_symbol": None, "start_line": 4, "end_line": 8, "source_type": "source_code", "task_tags": ["implementation"]},
        {"library": "lib", "module": "pkg.m", "symbol": "pkg.m.C.m", "symbol_type": "method", "parent_symbol": "pkg.m.C", "start_line": 7, "end_line": 8, "source_type": "source_code", "task_tags": ["implementation"]},
        {"library": "lib", "module": "pkg.m", "symbol": "pkg.m.f", "symbol_type": "function", "parent_symbol": None, "start_line": 10, "end_line": 11, "source_type": "source_code", "task_tags": ["deprecation", "implementation"]},
    ]
    assert got["s"] == [{"path": "bad.py", "symbol_type": "module", "source_type": "source_code", "task_tags": ["implementation"]}]
    assert got["n"] == [{"module": "const", "symbol_type": "module", "source_type": "source_code", "task_tags": ["implementation"]}]
    assert [(m["section"], m["change_category"], m["task_tags"]) for m in got["r"]] == [("1.0", "new_features", []), ("1.0 > Fixes", "bug_fixes", ["debug"]), ("1.0 > Fixes > Breaking", "breaking_changes", ["compatibility"])]
    assert len(got["m"]) == 2 and got["m"][0]["part_start_line"] == 1 and got["m"][1]["part_end_line"] == 101 and got["m"][1]["part_start_line"] == got["m"][0]["part_end_line"] + 1
    assert [r.section_path for r in found if r.document_id == "r"] == [["1.0"], ["1.0", "Fixes"], ["1.0", "Fixes", "Breaking"]]
    assert set(got) == {"p", "s", "n", "r", "m"}
