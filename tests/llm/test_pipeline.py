"""The corpus pipeline over planted cases, and the guard that lets it go."""

import os
import random
import shutil
import subprocess
import sys
import zlib
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(3000)]
    text = lambda n: "\n".join(" ".join(rng.choice(vocab) for _ in range(20)) for _ in range(n))
    rows, labels, kind = [], [], {}

    def add(t, what):
        i = len(rows)
        rows.append((i, t, "en", f"src{i % 4}", None if t is None else len(t)))
        kind.setdefault(what, []).append(i)
        labels.append((i, 1, int(what == "toxic")))
        return i

    for k in range(400):
        add(text(rng.randint(3, 9)), "clean")
        if k % 4 == 0:
            w = text(5).split(" ")
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vilest", "rotten", "scummy"]))
            add(" ".join(w), "toxic")
    passage = text(4)
    for _ in range(6):
        add(text(3) + "\n" + passage + "\n" + text(3), "passage")
    for i in kind["clean"][:20]:
        add(rows[i][1], "exact")
    for i in kind["clean"][20:40]:  # one word of each line changed would break five-word shingles; change few
        w = rows[i][1].replace("\n", " ").split(" ")
        w[len(w) // 2] = "changed"
        add(" ".join(w), "near")
    add(None, "odd")
    add("", "odd")
    d = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d), rows, kind, passage


def test_stages(spark, planted, tmp_path):
    import corpus_pipeline

    d, rows, kind, passage = planted
    docs, left = spark.read.parquet(f"{d}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, d).write.parquet(out)
        docs = spark.read.parquet(out)
        left[name] = docs.collect()
        if name != "encode":
            assert docs.columns == columns
    ids = {n: {r.doc_id for r in x} for n, x in left.items()}
    held = [i for i in kind["toxic"] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 10 and not ids["toxicity"] & set(held)
    assert set(kind["clean"] + kind["passage"] + kind["odd"]) <= ids["toxicity"]
    text = {r.doc_id: r.text for r in left["line_dedup"]}
    assert passage in text[kind["passage"][0]] and not any(passage in text[i] for i in kind["passage"][1:])
    assert all(text[i] == rows[i][1] for i in kind["clean"]) and all(r.n_chars == (None if r.text is None else len(r.text)) for r in left["line_dedup"])
    assert not ids["line_dedup"] & set(kind["exact"])
    assert set(kind["clean"]) <= ids["near_dedup"] and not ids["near_dedup"] & set(kind["near"])
    assert ids["mix"] <= ids["near_dedup"] and ids["encode"] == ids["mix"] and len(left["encode"]) == len(left["mix"])
    got = corpus_pipeline.run(spark, d).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in left["encode"])


def test_stages_take_empty_documents(spark, planted, tmp_path):
    import corpus_pipeline

    d, *_ = planted
    docs = spark.read.parquet(f"{d}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, d).count() == 0


def test_registry_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "terrawarp", tmp_path / "terrawarp", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0 and run.stdout.strip().endswith("[]")
