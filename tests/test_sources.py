import bz2
import glob
import gzip
import json

import pytest
from pyspark.sql import functions as F

from lodestone import sources as io
from lodestone.workloads import fixtures

from . import micro
from .plans import shuffled_rows


def test_read_corpus_excludes_files(spark, tmp_path):
    corpus = micro.corpus(spark)
    corpus.coalesce(1).write.parquet(f"{tmp_path}/c/wiki/part1")
    corpus.coalesce(1).write.parquet(f"{tmp_path}/c/pr_run")
    (tmp_path / "c" / "setup.sh").write_text("not parquet")
    (tmp_path / "c" / "postings_x").mkdir()
    (tmp_path / "c" / "postings_x" / "a.bin").write_bytes(b"\x00\x01")
    df = io.read_corpus(spark, f"{tmp_path}/c", ["setup.sh", "postings_*", "pr*"])
    assert io.corpus_count(df).first()["n"] == len(micro.ARTICLES)
    assert sorted(r.id for r in df.collect()) == [a[0] for a in micro.ARTICLES]
    titles = io.project_field(df, "title")
    assert titles.columns == ["doc_id", "title"]
    scan = titles._jdf.queryExecution().executedPlan().toString()
    assert "anchor_text" not in scan.split("ReadSchema")[1]
    both = io.read_corpus(spark, [f"{tmp_path}/c/wiki", f"{tmp_path}/c/pr_run"], ["nothing*"])
    assert both.count() == 2 * len(micro.ARTICLES)


def test_read_corpus_names_are_relative_to_the_folder(spark, tmp_path, monkeypatch):
    """Plain, relative, with scheme, wildcard, blanks and plus signs, several roots."""
    n = len(micro.ARTICLES)
    root = tmp_path / "my data+more"
    for folder in ("articles", "pr_old", "postings_x"):
        micro.corpus(spark).coalesce(1).write.parquet(f"{root}/{folder}")
    exclude = ["pr*", "postings_*"]
    monkeypatch.chdir(tmp_path)
    whole = [f"{root}", f"{root}/", f"file:{root}", f"file://{root}", f"{root}/*", f"{tmp_path}/my*/*"]
    for path in whole:
        assert io.read_corpus(spark, path, exclude).count() == n, path
    # A folder named outright is the root of its files, so its own name is not tested.
    assert io.read_corpus(spark, f"{root}/pr_old", exclude).count() == n
    assert io.read_corpus(spark, [f"{root}/pr_old", f"{root}/articles"], exclude).count() == 2 * n
    assert io.read_corpus(spark, f"{root}/*", ["*old/*"]).count() == 2 * n
    with pytest.raises(FileNotFoundError):
        io.read_corpus(spark, [f"{root}/articles", f"{tmp_path}/none*"], exclude)


def test_read_corpus_with_a_relative_path(spark, tmp_path):
    import os

    n = len(micro.ARTICLES)
    for folder in ("articles", "pr_old"):
        micro.corpus(spark).coalesce(1).write.parquet(f"{tmp_path}/rel/{folder}")
    # Spark resolves relative paths by the folder its session began in.
    path = os.path.relpath(f"{tmp_path}/rel", spark._jvm.java.lang.System.getProperty("user.dir"))
    assert io.read_corpus(spark, path, ["pr*"]).count() == n
    assert io.read_corpus(spark, f"{path}/*", ["pr*"]).count() == n


LINES = """en.wikipedia Apple 12 desktop 40 A1B2
en.wikipedia Apple 12 mobile-web 2 X
en.wikipedia.m Pear 13 desktop 5 X
fr.wikipedia Pomme 12 desktop 7 X
enXwikipedia Fake 12 desktop 9 X
en.wikipedia Null null desktop 3 X
en.wikipedia Odd 12a desktop 3 X
en.wikipedia Neg 12 desktop -3 X
en.wikipedia Short 12
en.wikipedia Big 14 desktop 5000000000 X
en.wikipedia Huge 12 desktop 99999999999999999999 X
en.wikipedia Far 99999999999999999999 desktop 1 X
"""


def test_pageview_dump(spark, tmp_path):
    path = tmp_path / "dump.bz2"
    path.write_bytes(bz2.compress(LINES.encode()))
    lines = io.read_pageview_dump(spark, str(path))
    totals = io.pageviews_by_article(io.parse_pageview_line(lines))
    assert sorted(map(tuple, totals.collect())) == [(12, 42), (13, 5), (14, 5000000000)]
    io.write_pageviews(totals, f"{tmp_path}/views")
    assert io.read_pageviews(spark, f"{tmp_path}/views").count() == 3
    french = io.parse_pageview_line(lines, "fr.wikipedia")
    assert [tuple(r) for r in french.collect()] == [(12, 7)]


def test_rank_csv_is_sorted_across_parts(spark, tmp_path):
    ranks = spark.range(1000).select(
        F.col("id").alias("doc_id"), ((F.col("id") * 37) % 1009 / 7).alias("pagerank"))
    path = f"{tmp_path}/pr"
    io.write_rank_csv(ranks, path)
    values = []
    for part in sorted(glob.glob(f"{path}/part-*.csv.gz")):
        with gzip.open(part, "rt") as lines:
            values += [(float(line.split(",")[1]), -int(line.split(",")[0])) for line in lines]
    assert len(values) == 1000 and values == sorted(values, reverse=True)
    again = io.read_rank_csv(spark, path)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, ranks.collect()))
    top = io.show_top_ranks(again, 3).collect()
    assert [r.pagerank for r in top] == [v for v, _ in values[:3]]


def test_qrels(spark, tmp_path):
    judged = {"best film": [3, 1, 2], "what is \"it\"?": [7], "none": []}
    (tmp_path / "one.json").write_text(json.dumps(judged))
    (tmp_path / "tall.json").write_text(json.dumps(judged, indent=2))
    expected = sorted((q, d) for q, ids in judged.items() for d in ids)
    one = io.read_qrels(spark, f"{tmp_path}/one.json")
    assert sorted(map(tuple, one.collect())) == expected
    tall = io.read_qrels(spark, f"{tmp_path}/tall.json", multi_line=True)
    assert sorted(map(tuple, tall.collect())) == expected
    io.write_qrels(one, f"{tmp_path}/out", span=2)
    lines = spark.read.text(f"{tmp_path}/out").collect()
    assert all(len(ids) <= 2 for r in lines for ids in json.loads(r.value).values())
    assert sorted(map(tuple, io.read_qrels(spark, f"{tmp_path}/out").collect())) == expected
    (tmp_path / "bad.json").write_text('{"q": [1]}\n\n{"q": [1, }\n')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        io.read_qrels(spark, f"{tmp_path}/bad.json").collect()


def test_the_fixture_corpus_shuffles_each_text_once(spark):
    """The join with the links deals texts into the parts that are stored."""
    sf = "/root/testdata/sf0.001"
    corpus = fixtures.corpus(spark, sf)
    corpus.collect()
    counts = [fixtures.table(spark, sf, name).count() for name in ("pages", "documents")]
    assert sorted(shuffled_rows(corpus)) == counts
