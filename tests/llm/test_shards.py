import zlib

from samples import ODD, SF, docs_of, none, odd  # noqa: F401

from themewell.llm import shards


def check(rows, got, n):
    sizes = sorted((len((t or "").encode()) + 8 for _, t, *_ in rows))
    assert sorted(r["size"] for r in got) == sizes
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, set()).add(None if t is None else zlib.crc32(t.encode()))
    assert all(r.text_crc32 in texts[r.doc_id] and r.law == "bytes" and r.grown_shard is None for r in got)
    ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert ids == sorted(ids)  # contiguous
    by = {}
    for r in ordered:
        by.setdefault(r["shard"], []).append(r)
    assert all([r["slot"] for r in part] == list(range(len(part))) for part in by.values())
    assert all(0 <= s < n for s in by)
    target, largest = sum(sizes) / n, max(sizes)
    assert all(abs(sum(r["size"] for r in by.get(s, [])) - target) <= largest for s in range(n))


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = shards.assign(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    check(rows, got, 24)


def test_odd_rows(odd, none):
    check(ODD, shards.assign(odd, 3).collect(), 3)
    assert shards.assign(none).collect() == []


def test_native_plan(spark):
    plan = shards.assign(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_write(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    shards.write(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select(*docs.columns).exceptAll(docs).isEmpty() and back.count() == docs.count()
