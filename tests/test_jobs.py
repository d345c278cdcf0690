"""The composed jobs on small hand-made tables, against plain models and with forced splits."""

import random

import pytest
from pyspark.sql import functions as F

from tagtable.operators import copies, perkey
from tagtable.operators.perkey import limit_by
from tagtable.operators.tags import emit_tags
from tagtable.plans.customer_tags import customer_tags, data_date_of, load_customer_tags
from tagtable.plans.customer_wide import build_customer_wide
from tagtable.plans.decode_preview import decode_preview, with_name_containing
from tagtable.plans.extract import customer_extract
from tagtable.plans.latest_campaigns import build_latest_campaigns, latest_campaigns
from tagtable.plans.relation import matched_source, pick_relation
from tagtable.session import work_folder
from tagtable.sources import dictionary
from tagtable.sources.dictionary import CodeBook
from tagtable.specs import PREVIEW_SCHEMA, TAGS

RELATION = "custId,entId,createTime,custName,updateTime"
BASE = "ent_id,estimate_date,cnei_code,cnei_sec_code,province_code,city_code,county_code,oper_scope"


def test_relation_takes_the_oldest_named_enterprise(frame, rows):
    data = [
        ("c1", "", "t", "n", "2020-01-01"),  # blank and missing enterprises go before the pick
        ("c1", None, "t", "n", "2020-01-02"),
        ("c1", "e2", "t", "n", "2020-01-04"),
        ("c1", "e1", "t", "n", "2020-01-03"),
        ("c2", "e9", "t", "n", None),  # no time comes last
        ("c2", "e3", "t", "n", "2021-01-01"),
        ("c3", "e5", "t", "n", "2021-01-01"),  # same time: the smaller enterprise
        ("c3", "e4", "t", "n", "2021-01-01"),
        ("c4", "", "t", "n", "2021-01-01"),
        ("c5", "e6", "t", "n", None),
    ]
    got = pick_relation(frame(RELATION, data))
    assert rows(got, "custId", "entId") == [("c1", "e1"), ("c2", "e3"), ("c3", "e4"), ("c5", "e6")]


def test_limit_by_keeps_n_rows(frame, rows):
    data = frame("k,v", [("a", "3"), ("a", "1"), ("a", "2"), ("b", "9"), ("b", None)])
    got = limit_by(data, ["k"], [F.asc_nulls_last("v")], 2)
    assert rows(got) == [("a", "1"), ("a", "2"), ("b", None), ("b", "9")]


def test_limit_by_beyond_the_group_limit(frame, rows, monkeypatch):
    data = frame("k,v", [("a" if i % 3 else "b", f"{i:03}") for i in range(90)])
    order = [F.col("v")]
    wanted = rows(limit_by(data, ["k"], order, 7))
    monkeypatch.setattr(perkey, "GROUP_LIMIT", 3)
    assert rows(limit_by(data, ["k"], order, 7)) == wanted and len(wanted) == 14


def test_matched_source(frame, rows):
    dim = frame("cust_id,x", [("c1", ""), ("c1", ""), ("c2", ""), ("c3", "")])
    relation = frame("custId,entId,createTime,custName", [("c1", "e1", "t1", "n1"), ("c3", None, "t", "n")])
    got = matched_source(dim, relation, partitions=3)
    assert rows(got, "cust_id", "ent_id", "createDate", "custNameCn") == [("c1", "e1", "t1", "n1")] * 2


def wide_inputs(frame, seed=1, customers=60):
    rng = random.Random(seed)
    enterprises = [f"e{i}" for i in range(15)] + ["hot"] * 10
    dim = [(f"c{i}",) for i in range(customers)] + [("c1",), ("c1",), ("c59",), (None,)]
    relation = [
        (f"c{rng.randrange(customers + 5)}", rng.choice([*enterprises, "", None]), f"t{i}", f"n{i}", f"{rng.randrange(9)}")
        for i in range(80)
    ]
    facts = {f"t{k}": [(rng.choice([*enterprises, None]),) for _ in range(12)] for k in range(1, 6)}
    capital = [(rng.choice(enterprises), str(rng.randrange(3))) for _ in range(40)] + [(None, "9")]
    base = [
        (rng.choice(enterprises[:13] + ["hot"] * 5), str(i), "A", None, "P", "Q", None, rng.choice(["x 进出口 y", "z", None]))
        for i in range(25)
    ]
    return (
        frame("cust_id string, x string", [(c, "") for (c,) in dim]).select("cust_id"),
        frame(RELATION, relation),
        {k: frame("ent_id string, x string", [(e, "") for (e,) in v]) for k, v in facts.items()},
        frame("ent_id,reg_caps2", capital),
        frame(BASE, base),
    ), (dim, relation, facts, capital, base)


def wide_model(dim, relation, facts, capital, base):
    """The result by loops, joining the enriched customers back to the whole population."""
    picked = {}
    for cust, ent, time, name, update in sorted(
        (r for r in relation if r[1]), key=lambda r: (r[4] is None, r[4], r[1], r[2], r[3])
    ):
        picked.setdefault(cust, (ent, time, name))
    caps = set(capital)
    enriched = []
    for (cust,) in dim:
        if cust in picked:
            ent = picked[cust][0]
            flags = [int((ent,) in facts[f"t{k}"]) for k in range(1, 6)]
            for cap in [c[1] for c in caps if c[0] == ent] or [None]:
                for b in [b for b in base if b[0] == ent] or [(ent,) + (None,) * 7]:
                    t6 = int("进出口" in b[7]) if b[7] else 0
                    enriched.append((cust, *flags, t6, cap, *b[1:7]))
    result = []
    for (cust,) in dim:
        mine = [e for e in enriched if cust is not None and e[0] == cust]
        head = picked.get(cust, (None, None, None))[1:]
        result += [(cust, *head, *e[1:]) for e in mine] or [(cust, None, None) + (None,) * 13]
    return result


@pytest.mark.parametrize("rows_per_task", [2_000_000, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_customer_wide(frame, rows, monkeypatch, seed, rows_per_task):
    monkeypatch.setattr(copies, "COPIES_PER_CHUNK", 2)
    inputs, plain = wide_inputs(frame, seed)
    got = build_customer_wide(*inputs, rows_per_task=rows_per_task)
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert rows(got) == sorted(wide_model(*plain), key=key)


def test_wide_splits_are_measured(frame):
    from tagtable.plans.customer_wide import measure_splits

    inputs, _ = wide_inputs(frame)
    splits = measure_splits(inputs[0], inputs[1], inputs[3], inputs[4], 2)
    assert "c1" in splits["dimension"]  # its rows come out squared
    assert splits["relation"]["hot"] > 1 and splits["base_info"]["hot"] > 1


def test_tags_rows_labels_and_nulls(frame, rows):
    wide = frame(
        "cust_id string, createDate string, custNameCn string, t1 int, t2 int, t3 int, t4 int, t5 int, t6 int, "
        "reg_caps2 string, estimate_date string, cnei_code string, cnei_sec_code string, province_code string, "
        "city_code string, county_code string",
        [
            ("c1", "d", "n", 1, 0, 1, 0, 1, 0, "5", "e", "A\u0002?\u0002B", "B", "P", "?", None),
            ("c2",) + (None,) * 15,
        ],
    )
    industries = CodeBook(frame("code,name", [("A", "nameA"), ("B", "nameB")]))
    regions = CodeBook(frame("code,name", [("P", "province")]))
    got = customer_tags(wide, industries, regions, "2024-03-01")
    result = {(r["CUST_ID"], r["TAG_CODE"]): (r["TAG_VALUE"], r["TAG_VALUE_NAME"]) for r in got.collect()}
    assert got.count() == len(result) == 2 * len(TAGS)
    assert got.select("DATA_DATE").distinct().collect()[0][0] == "2024-02-29"
    assert {code: result["c1", code] for code in (s.code for s in TAGS)} == {
        "CRE_DATE": ("d", None), "CUST_NAME": ("n", None), "IS_TRADEMARK": ("1", "有"), "IS_PATENT": ("0", "无"),
        "IS_CHANGE_LICENSE": ("1", "是"), "IS_PROMOTION": ("0", "无"), "IS_OFFICIAL_ACCOUNT": ("1", "有"),
        "IS_IO": ("0", "无"), "REG_CAPS": ("5", None), "ESTIMATE_DATE": ("e", None),
        "CNEI_CODE": ("A\u0002?\u0002B", "nameA,"), "CNEI_SEC_CODE": ("B", "nameB"),
        "MAILING_ADDR_PROVINCE": ("P", "province"), "MAILING_ADDR_CITY": ("?", ""), "MAILING_ADDR_ZONE": (None, ""),
    }
    coded = {"CNEI_CODE", "CNEI_SEC_CODE", "MAILING_ADDR_PROVINCE", "MAILING_ADDR_CITY", "MAILING_ADDR_ZONE"}
    assert all(result["c2", s.code] == (None, "" if s.code in coded else None) for s in TAGS)


def test_tags_with_large_dictionaries(frame, rows, monkeypatch):
    inputs, _ = wide_inputs(frame)
    book = CodeBook(frame("code,name", [("A", "nameA"), ("P", "p"), ("Q", "q")]))
    wide = build_customer_wide(*inputs)
    small = rows(emit_tags(wide, "cust_id", "2024-01-01", book, book))
    monkeypatch.setattr(dictionary, "BROADCAST_CODES", 1)
    large = CodeBook(frame("code,name", [("A", "nameA"), ("P", "p"), ("Q", "q")]))
    assert not large.fits()
    assert rows(emit_tags(wide, "cust_id", "2024-01-01", large, large)) == small


def test_tag_job_rerun(spark, frame):
    inputs, _ = wide_inputs(frame)
    book = CodeBook(frame("code,name", [("A", "nameA")]))
    wide, path = build_customer_wide(*inputs), work_folder(spark)
    for day in ("2024-01-02", "2024-01-03", "2024-01-02"):
        load_customer_tags(wide, book, book, day, path)
    per_day = {str(r[0]): r[1] for r in spark.read.parquet(path).groupBy("DATA_DATE").count().collect()}
    assert per_day == dict.fromkeys(["2024-01-01", "2024-01-02"], wide.count() * len(TAGS))
    assert data_date_of("2024-03-01") == "2024-02-29"


PROMOTION = "ent_id,popu_keyword,popu_plat,popu_type,sem_url,modify_time"


def test_campaign_rules(frame, rows):
    promotion = frame(
        PROMOTION,
        [
            ("e1", "b", "p", "y", "u", "2024-01-05 08:00:00"),  # two times of the latest day
            ("e1", "a", "p", "y", "u", "2024-01-05 21:00:00"),
            ("e1", "a", "p", "y", "u", "2024-01-05 21:00:00"),
            ("e1", None, "p", "y", "u", "2024-01-05"),
            ("e1", "z", "q", "y", "u", "2024-01-05"),
            ("e1", "old", "p", "y", "u", "2024-01-04 23:59:59"),
            ("e1", "bad", "p", "y", "u", "no date"),
            ("e2", "k", "p", "y", "u", None),  # only missing and malformed days
            ("e2", "k2", "p", "y", "u", "13/13/13"),
            ("e3", None, "p", None, None, "2024-01-01"),  # no keyword, missing attributes
            (None, "k", "p", "y", "u", "2024-01-09"),
            ("e9", "k", "p", "y", "u", "2024-01-09"),
        ],
    )
    source = frame("cust_id,ent_id", [("c1", "e1"), ("c2", "e2"), ("c3", "e3"), ("c3", "e3"), ("c4", "e4"), ("c5", None)])
    wanted = [
        ("c1", "p", "y", "u", "2024-01-05", "a,b"),
        ("c1", "q", "y", "u", "2024-01-05", "z"),
        ("c2", "p", "y", "u", None, "k,k2"),
        ("c3", "p", None, None, "2024-01-01", ""),
    ]
    for one in (False, True):
        for splits in (None, {"promotion": {"e1": 3}, "source": {"e3": 2}, "customer": {"c1": 2}}):
            got = latest_campaigns(source, promotion, "2024-02-01", one, splits)
            got = got.withColumn("RELEASE_TIME", F.col("RELEASE_TIME").cast("string"))
            assert rows(got.drop("DATA_DATE")) == wanted


def test_campaigns_of_several_enterprises(frame, rows):
    """The latest day counts among all enterprises of a customer, and their keywords merge."""
    promotion = frame(
        PROMOTION,
        [
            ("e1", "a", "p", "y", "u", "2024-01-05"),
            ("e2", "b", "p", "y", "u", "2024-01-05"),
            ("e2", "c", "q", "y", "u", "2024-01-03"),
            ("e3", "d", "p", "y", "u", "2024-01-04"),
            ("e4", "e", "p", "y", "u", None),
        ],
    )
    source = frame("cust_id,ent_id", [("c1", "e1"), ("c1", "e2"), ("c1", "e3"), ("c1", "e4"), ("c2", "e3"), ("c2", "e4")])
    got = latest_campaigns(source, promotion, "2024-02-01")
    assert rows(got, "CUST_ID", "POPU_PLAT", "POPU_KEYWORD_LIST") == [("c1", "p", "a,b"), ("c2", "p", "d")]


@pytest.mark.parametrize("seed", [1, 2])
def test_campaigns_with_measured_splits(frame, rows, seed):
    rng = random.Random(seed)
    enterprises = [f"e{i}" for i in range(10)] + ["hot"] * 8
    dim = frame("cust_id,x", [(f"c{i % 50}", "") for i in range(60)]).select("cust_id")
    relation = frame(RELATION, [(f"c{i}", rng.choice(enterprises), "t", "n", "1") for i in range(55)])
    days = ["2024-01-01 10:00:00", "2024-01-02", "x", None]
    promotion = frame(
        PROMOTION,
        [(rng.choice(enterprises), str(rng.randrange(9)), rng.choice("pq"), "y", "u", rng.choice(days)) for _ in range(200)],
    )
    plain = rows(build_latest_campaigns(dim, relation, promotion, "2024-02-01"))
    assert rows(build_latest_campaigns(dim, relation, promotion, "2024-02-01", rows_per_task=5)) == plain
    picked = pick_relation(relation).selectExpr("custId as cust_id", "entId as ent_id")
    assert rows(latest_campaigns(dim.join(picked, "cust_id"), promotion, "2024-02-01")) == plain


def test_decode_preview(frame, rows, monkeypatch):
    columns = "ent_id string, " + ", ".join(f"t{i} int" for i in range(1, 7))
    columns += "".join(
        f", {c} string"
        for c in "reg_caps2 estimate_date cnei_code cnei_sec_code province_code city_code county_code".split()
    )
    data = [(f"e{i}", 1, 0, 1, 0, 1, 0, "5", "d", code, "M", "P", None, "?") for i, code in enumerate(["M", "S", "M\u0002S", None, "M"])]
    coded = frame(columns, data)
    names = [("M", "食品制造业 "), ("S", "服务业")]
    industries, regions = CodeBook(frame("code,name", names)), CodeBook(frame("code,name", [("P", "province")]))
    got = decode_preview(coded, industries, regions)
    assert got.dtypes == [(f.name, f.dataType.simpleString()) for f in PREVIEW_SCHEMA]
    wanted = [(e, "食品制造业 ", "食品制造业 ", "province", "", "") for e in ("e0", "e4")]
    assert rows(got, "ent_id", "cnei", "cnei_sec", "province", "city", "county") == wanted
    assert rows(decode_preview(coded, industries, regions, rows=1), "ent_id") == [("e0",)]
    small = rows(with_name_containing(coded, "cnei_code", industries, "业"), "ent_id")
    monkeypatch.setattr(dictionary, "BROADCAST_CODES", 1)
    large = CodeBook(frame("code,name", names))
    assert rows(with_name_containing(coded, "cnei_code", large, "业"), "ent_id") == small == [("e0",), ("e1",), ("e4",)]


@pytest.mark.parametrize("rows_per_task", [2_000_000, 2])
def test_extract(frame, rows, rows_per_task):
    customers = frame("custId,x", [("c1", ""), ("c1", ""), ("c2", ""), ("c3", ""), (None, "")])
    master = frame("custId,custNameCn,createDate", [("c1", "n1", "d1"), ("c3", "n3", "d3"), ("c3", "n4", "d4")])
    relation = frame("custId,entId", [("c1", "e1"), ("c1", "e2"), ("c1", "e2"), ("c2", "e3"), ("c9", "e9")])
    got = customer_extract(customers, master, relation, rows_per_task)
    assert rows(got) == sorted(
        [("c1", "n1", "d1", e) for e in ("e1", "e2", "e2")] * 2
        + [("c2", None, None, "e3"), ("c3", "n3", "d3", None), ("c3", "n4", "d4", None), (None, None, None, None)],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )
