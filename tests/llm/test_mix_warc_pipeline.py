"""Mixing, archives, the registered queries' SQL and the pipeline."""

import os
import sys
from collections import Counter

import pytest
from compare import difference, sql_connection
from pyspark.sql import functions as F

import corpus_pipeline
from rivulet.llm import mixing, queries, warc
from rivulet.operators.rowsets import shared_folder


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, sf_dir, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), sql_connection(sf_dir), queries.ORACLE[name]) is None


def test_operators_are_registered():
    import __spark_entry__ as entry_point

    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert entry_point.queries()["pipeline"] is corpus_pipeline.run


def targets_by_rounds(sizes):
    """Share by weight, cut at three times the size, share the excess again."""
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: k % 3 + 1 for k, n in enumerate(names)}
    total, target, open_ = sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    left = float(total)
    while open_ and left > 1e-9:
        whole = sum(weight[n] for n in open_)
        for n in list(open_):
            target[n] += left * weight[n] / whole
        left = 0.0
        for n in list(open_):
            if target[n] >= 3 * sizes[n]:
                left += target[n] - 3 * sizes[n]
                target[n] = 3.0 * sizes[n]
                open_.discard(n)
    return target


def test_targets_and_copies(spark, odd_docs, no_docs):
    rows = mixing.mixture(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    again = sorted((tuple(r) for r in mixing.mixture(odd_docs.repartition(5)).collect()), key=str)
    assert again == sorted((tuple(r) for r in rows), key=str)
    taken = Counter(r.doc_id for r in mixing.mixed_documents(odd_docs).collect())
    assert sum(taken.values()) == sum(r.copies for r in rows)
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
    assert mixing.mixture(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_targets_share_the_excess(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 700, "e": 0, None: 40}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(df, mixing.cyclic_weights(1, 2, 3)).collect()}
    told = targets_by_rounds(sizes)
    assert all(abs(found[n] - told[n]) < 1e-6 for n in sizes)


def test_copies_follow_the_expected_sum(spark):
    docs = spark.range(2000).withColumn("size", F.col("id") % 90).withColumn("units", (F.col("id") % 5) * (mixing.UNIT // 3))
    rows = mixing.systematic_copies(docs, F.col("units"), F.lit("g"), F.col("size"), F.col("id")).collect()
    assert abs(sum(r._copies for r in rows) - sum(r.units for r in rows) / mixing.UNIT) <= 1
    assert all(r.units // mixing.UNIT <= r._copies <= r.units // mixing.UNIT + 1 for r in rows)


PAGES = [
    (1, "http://a/1", "x" * 1200),
    (2, "http://a/2", "x" * 1200),
    (3, None, "x" * 1200),
    (3, None, "x" * 1200),
    (4, "http://a/\r\nX-Bad: 1 ", "short"),
    (5, "http://a/5", "short"),
    (6, "", None),
    (None, "http://a/7", "é" * 600),
    (8, "http://a/8", "é" * 600),
    (9, "http://a/9", "\r\n\r\nWARC/1.1\r\n" * 300),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, record_type string, path int")
    rows = warc.round_trip(spark, pages).collect()
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in rows), key=str)
    assert kinds == sorted(
        [(1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (3, "response", None), (4, "response", None),
         (5, "response", None), (6, "response", None), (None, "revisit", 8), (8, "response", None), (9, "response", None)],
        key=str,
    )
    written = warc.write_archives(warc.with_revisits(pages), shared_folder(spark, "warc"), archive_bytes=2000)
    assert written.count() > 1
    payloads = [bytes(r.payload).decode() for r in warc.read_archives(written).where("payload IS NOT NULL").collect()]
    assert sorted(payloads) == sorted(["x" * 1200] * 2 + ["short"] * 2 + [""] + ["é" * 600] + [PAGES[-1][2]])
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_archives_are_read_by_as_many_tasks(spark):
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id AS string), 300) AS html")
    written = warc.write_archives(warc.with_revisits(pages), shared_folder(spark, "warc"), archive_bytes=500)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert written.count() >= most
    assert warc.read_archives(warc.spread(written)).rdd.getNumPartitions() == most
    few = warc.spread(written.limit(3))
    assert few.rdd.getNumPartitions() == 3


def test_equal_pages_meet_in_several_places(spark):
    pages = spark.range(400).selectExpr("id AS page_id", "cast(id AS string) AS url", "if(id < 300, repeat('x', 2000), 'y') AS html")
    found = warc.with_revisits(pages)
    rows = {r.page_id: (r.record_type, r.refers_to) for r in found.collect()}
    assert rows == {i: ("revisit", 299) if i < 299 else ("response", None) for i in range(400)}


def test_broken_archives_are_refused(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "text " * 300 + str(i)) for i in range(20)], "page_id long, url string, html string")
    folder = str(tmp_path / "w")
    written = warc.write_archives(warc.with_revisits(pages).coalesce(1), folder)
    path = written.first().path.removeprefix("file://")
    whole = open(path, "rb").read()
    for broken in (whole[:-5], whole[8:], whole[:200] + bytes([whole[200] ^ 255]) + whole[201:]):
        with open(path, "wb") as out:
            out.write(broken)
        with pytest.raises(Exception):
            warc.read_archives(written).count()


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, folder)
        assert done.columns == docs.columns, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
        docs = done
    assert docs.count() > 0
    assert corpus_pipeline.run(spark, folder).count() == docs.count()


def test_library_does_without_the_subpackage():
    code = (
        "import sys; sys.modules['rivulet.llm'] = None; sys.path.insert(0, '.'); "
        "import importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name.split('.')[:2] == ['rivulet', 'llm'] or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "del sys.modules['rivulet.llm']; sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) > 100"
    )
    import subprocess

    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert subprocess.run([sys.executable, "-c", code], cwd=top).returncode == 0
