"""Missing values, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

import corpus_pipeline
from tagtable.llm import archives, decontamination, fingerprints, jaccard, mixing, quality, secrets, sharding, token_counts, token_files
from tagtable.llm.tokenizer import public_path
from tagtable.session import work_folder


def written(docs):
    path = work_folder(docs.sparkSession)
    token_files.write_tokens(docs, path, public_path("word_bpe_49k.json"), 2)
    return token_files.read_tokens(docs.sparkSession, path)


def benchmark(spark):
    words = "one two three four five six seven eight nine ten eleven twelve thirteen"
    return spark.createDataFrame([(1, words), (2, None), (3, ""), (4, "same number"), (5, words)], "item_id long, text string")


OPERATORS = {
    "jaccard": jaccard.classes,
    "tokens": written,
    "secrets": secrets.find_secrets,
    "mixing": mixing.mix_report,
    "contamination": lambda d: decontamination.find_contamination(d, benchmark(d.sparkSession)),
    "counts": lambda d: token_counts.count_tokens(d, public_path("piece_bpe_32k.model")),
    "fingerprints": fingerprints.compared_with_next,
    "quality": lambda d: quality.classify(d, quality.fit(d, d.selectExpr("doc_id", "1 as quality", "0 as toxic"))),
    "sharding": lambda d: sharding.shard(d, 4),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_result_for_every_row(odd, none, name):
    ids = lambda frame: Counter(r[0] for r in frame.select("doc_id").collect())
    assert ids(OPERATORS[name](odd)) == ids(odd)
    assert OPERATORS[name](none).collect() == []


def test_defined_results(spark, odd):
    classes = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.classes(odd, 4, 85).collect()}
    assert classes[(6, 11)] == 5 and classes[(1, 0)] == 1 and classes[(4, 1)] == 4
    found = {(r.doc_id, r.n_words): r for r in OPERATORS["contamination"](odd).collect()}
    assert found[(5, 14)].n_hit == 13 and found[(5, 14)].items == ["1", "5"]
    assert found[(5, 9)].n_hit == 2 and found[(5, 9)].items == ["4"]
    assert found[(2, 0)].n_hit == 0
    spans = [(s.kind, s.start, s.end) for r in secrets.find_secrets(odd).where("doc_id = 9").collect() for s in r.spans]
    assert spans == [("assign", 0, 25), ("access", 26, 47), ("hex", 48, 76)]


def test_mix_repeats_whole_rows(odd):
    wanted = {r.doc_id: r.taken // r.size for r in mixing.mix_report(odd).collect() if r.size}
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    got = Counter(r.doc_id for r in mixed.where(mixing.word_count(F.col("text")) > 0).collect())
    assert all(got[i] == n * (2 if i == 5 and got[i] else 1) or i == 5 for i, n in wanted.items())


def test_one_of_each_class(odd):
    stay = jaccard.one_of_each(odd)
    assert stay.columns == odd.columns
    texts = [(r.doc_id, (r.text or "")[:20]) for r in stay.collect()]
    assert Counter(texts)[(5, "one two three four f")] == 1 and (6, "ONE TWO THREE FOUR F") not in texts
    assert len(texts) == odd.count() - 2


def test_token_files_have_stripes_indexes_and_filters(spark):
    import glob

    import pyarrow.orc as orc

    docs = spark.range(2000).selectExpr("id as doc_id", "concat('text of number ', id) as text")
    path = work_folder(spark)
    token_files.write_tokens(docs, path, public_path("word_bpe_49k.json"), 2)
    files = [orc.ORCFile(f) for f in glob.glob(f"{path}/*.orc")]
    assert sum(f.nrows for f in files) == 2000 and all(f.row_index_stride == 1000 for f in files if f.nrows)
    assert [r.doc_id for r in token_files.lookup(spark, path, [1234, 77]).orderBy("doc_id").collect()] == [77, 1234]
    plan = token_files.lookup(spark, path, [77])._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters: [") :].split("]")[0]
    assert "EqualTo(doc_id,77)" in pushed or "In(doc_id" in pushed


def test_archives_of_odd_pages(spark):
    big = "<p>same</p>" * 200
    rows = [(1, "http://a/ b\r\nX: y", big, 1), (3, None, big, 1), (2, "http://b", big, 1), (3, "http://c", big, 1), (4, "", None, 1), (None, "http://d", big, 1), (5, "http://e", "short", 1), (6, "http://e", "short", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, _salt int").repartition(3)
    path = work_folder(spark)
    archives.write_archives(pages, path)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in archives.read_archives(spark, path).collect()), key=str)
    wanted = [(1, "revisit", 3, 2200), (2, "revisit", 3, 2200), (3, "response", None, 2200), (3, "response", None, 2200), (4, "response", None, 0), (None, "revisit", 3, 2200), (5, "response", None, 5), (6, "response", None, 5)]
    assert got == sorted(wanted, key=str)
    assert archives.read_archives(spark, path).where("page_id = 1").first().url == "http://a/%20b%0D%0AX:%20y"


@pytest.mark.parametrize("change", ["cut", "length", "digest", "magic"])
def test_bad_archives_are_refused(change):
    made = archives.record(1, "http://a", b"hello" * 300, "0" * 40, None)
    import hashlib

    made = made.replace(b"0" * 40, hashlib.sha1(b"hello" * 300).hexdigest().encode())
    coder, frames = archives._start([made, made])
    good = b"".join(f + archives.SEPARATOR for f in frames)
    assert [archives.page_of(*r)[0] for r in archives.records_of(good)] == [1, 1]
    bad = {"cut": good[:-20], "magic": b"xxxx" + good}.get(change)
    if change == "length":
        bad = frames[0] + coder.compress(made + b"more")
    if change == "digest":
        bad = frames[0] + coder.compress(made.replace(b"hellohello", b"hallohallo", 1))
    with pytest.raises(archives.ArchiveError):
        [archives.page_of(*r) for r in archives.records_of(bad)]


def test_pages_table_may_be_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = work_folder(spark)
    archives.write_archives(pages, path)
    assert archives.read_archives(spark, path).collect() == []


def test_stages_keep_columns(spark, odd, none):
    schema = StructType([StructField(f.name, f.dataType if f.name != "doc_id" else LongType()) for f in odd.schema])
    for frame in (odd, none):
        docs = spark.createDataFrame(frame.rdd, schema) if frame is odd else frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == odd.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).columns == ["doc_id", "size", "text_crc32", "shard", "slot"]


def test_near_copies_go_and_clean_documents_stay(spark):
    """The pipeline on planted cases: junk and copies go, benchmark passages go, the rest stays and is sharded."""
    prose = lambda i: ". ".join(" ".join(f"word{i}x{j}y{k}" for k in range(9)).capitalize() for j in range(9)) + "."
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    rows = [(i, prose(i), f"s{i % 3}", "en", 0) for i in range(30)]
    rows += [(100 + i, prose(i).replace(f"word{i}x0y0", "other"), "s0", "en", 0) for i in range(10)]
    rows += [(200, item + " " + prose(900), "s1", "en", 0), (201, "STOP!! " * 300, "s1", "en", 0), (202, "na na " * 200, "s1", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        seen = stage(spark, seen, SMALL)
        ids = sorted(r.doc_id for r in seen.select("doc_id").collect())
        if name == "quality classifier":
            assert set(range(30)) <= set(ids) and not {201, 202} & set(ids)
        elif name == "n-gram Jaccard join":
            assert ids == [*range(30), 200]
        else:
            assert ids == list(range(30))


def test_items_of_one_letter_after_empty_ones(spark):
    items = spark.createDataFrame([(1, ""), (2, "x"), (3, None), (4, "y"), (5, "z")], "item_id long, text string").coalesce(1)
    docs = spark.createDataFrame([(1, "x y"), (2, "z")], "doc_id long, text string")
    found = {r.doc_id: r["items"] for r in decontamination.find_contamination(docs, items).collect()}
    assert found == {1: ["2", "4"], 2: ["5"]}
