"""The pipeline's stages on planted rows, and the guard around the subpackage."""

import random
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from pingline.llm import near_dedup, packing
from pingline.llm.queries import QUERIES

ROOT = Path(__file__).resolve().parents[2]
RNG = random.Random(12)
WORDS = ["".join(RNG.choice("abcdefghiklmnoprstu") for _ in range(RNG.randint(3, 7))) for _ in range(3000)]


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def test_stages(ready, tmp_path):
    clean = [(i, prose(120)) for i in range(40)]
    passage = prose(60)
    rows = [*clean, (100, clean[0][1]), (101, clean[1][1].replace(" ", "  ")), (102, clean[2][1] + " end"), (103, "too short"),
            (104, "again and again this " * 60), (105, prose(50) + " " + passage), (106, prose(40) + " " + passage + " " + prose(40)), (107, None), (108, "")]
    table = ready.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    ready.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = ready.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(ready, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = ready.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.dtypes == table.dtypes
        seen[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    base = set(range(40)) | {105, 106}
    assert seen["quality rules"] == base | {100, 101, 102}
    assert seen["exact dedup"] == base | {102}
    # the stage keeps the smallest id of every group that the operator's bit distance links
    left = {r["doc_id"]: near_dedup.fingerprint(r["text"].encode()) for r in ready.read.parquet(f"{tmp_path}/1").collect()}
    linked = {i: min(j for j in left if (left[i] ^ left[j]).bit_count() <= near_dedup.BITS) for i in left}  # no longer chains here
    assert seen["near dedup"] == {i for i, first in linked.items() if first == i} and base <= seen["near dedup"]
    assert seen["suffix dedup"] == seen["near dedup"] and seen["packing"] == seen["suffix dedup"]
    cut = {r["doc_id"]: r["text"] for r in ready.read.parquet(f"{tmp_path}/3").collect()}
    assert passage in cut[105] and passage[10:-10] not in cut[106] and all(cut[i] == t for i, t in clean)
    whole = corpus_pipeline.run(ready, str(tmp_path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_empty_tables(ready, tmp_path):
    ready.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    ready.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(ready, str(tmp_path)).count() == 0


def test_queries_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "suffix dedup", "packing"]
    assert packing.WINDOW == 2048


def test_the_rest_works_without_this_subpackage():
    code = "import sys; sys.modules['pingline.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'cdr_agg_hour' in e.queries() and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
    sources = [p for p in (ROOT / "pingline").rglob("*.py") if "llm" not in p.parts]
    assert not [p for p in sources if "pingline.llm" in p.read_text() or "corpus_pipeline" in p.read_text()]
