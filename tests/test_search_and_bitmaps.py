"""Trigram search against a scan, bitmap counts against DISTINCT, and the ALL row beside rows without an agent."""

import datetime as dt
import os
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import bitmaps as B
from ledgerline.operators import textindex as X
from ledgerline.plans import activity as A
from ledgerline.plans import agent_tables as T
from ledgerline.sources import standins as S

NAMES = ["Ana Ö. Banana", "banana split", "ANA", "an", "", None, "Łukasz naNA", "a\\b % _ 'x'", "nananana" * 50, "İstanbul ana", "x" * 400]


@pytest.fixture(scope="module")
def people(spark, tmp_path_factory):
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(NAMES)] + [(1, "banana split"), (None, "banana")], "id long, name string")
    path = str(tmp_path_factory.mktemp("index"))
    X.write_index(rows, "id", F.col("name"), path)
    return rows, path


@pytest.mark.parametrize("q", ["ana", "NANA", " banana ", "an", "a", "", "zzz", "anaz", "ö. b", "% _", "'x'", "xxxx", "nanananana", "\\b"])
def test_index_equals_a_scan(spark, people, q):
    rows, path = people
    plain = q.strip().lower()
    want = sorted(str(r.id) for r in rows.filter(F.instr(F.lower("name"), plain) > 0 if plain else F.lit(True)).collect())
    got = sorted(str(r.id) for r in X.search(rows, "id", F.col("name"), path, q).collect())
    indexed = 3 <= len(plain)
    assert got == ([k for k in want if k != "None"] if indexed else want)  # a row without a key is in no posting


def test_candidates_read_postings_only(spark, people):
    _, path = people
    p = X.candidates(spark, path, "banana")._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in p.splitlines() if "FileScan" in x]
    assert scans and all("postings" in x and "PartitionFilters: [" in x and "p#" in x for x in scans)
    assert {r.key for r in X.candidates(spark, path, "banana").collect()} == {0, 1}


def test_an_index_is_written_by_tasks_of_bounded_size(spark, tmp_dir, monkeypatch):
    """One read task, a trigram of every text, copied rows and a key with two texts: no task of the writer takes more for it."""
    monkeypatch.setattr(X, "TASK_POSTINGS", 2000)
    people = [(k, f"Member #{k:05d}") for k in range(3000)]
    people += [people[0]] * 500 + [(1, "member of two"), (None, "member"), (5000, None), (5001, "me")]
    rows = spark.createDataFrame(people, "id long, name string").coalesce(1)
    X.write_index(rows, "id", F.col("name"), tmp_dir)
    kept = spark.read.parquet(f"{tmp_dir}/postings").select("gram", "key", F.input_file_name().alias("file")).collect()
    want = {(n.lower()[i:i + 3], k) for k, n in people if k is not None and n is not None for i in range(len(n) - 2)}
    assert len(kept) == len(want) and {(r.gram, r.key) for r in kept} == want
    assert {r.gram: r.n for r in spark.read.parquet(f"{tmp_dir}/counts").collect()} == dict(Counter(g for g, _ in want))
    assert max(Counter(r.file for r in kept).values()) <= 2 * X.TASK_POSTINGS
    assert len({r.file for r in kept if r.gram == "mem"}) > 1
    # Postings are dealt before they are gathered, and not gathered by the task that reads the texts.
    plan = X._postings(X._texts(rows, "id", F.col("name")))._jdf.queryExecution().executedPlan().toString()
    dealt, read = plan[plan.index("rangepartitioning"):].split("Generate explode", 1)
    assert "Aggregate" not in dealt and "Aggregate" not in read[read.index("hashpartitioning"):]


def test_indexed_member_search_prunes_before_the_asof(spark, tmp_dir):
    forms, member, services = S.reachout_forms(spark, SF_SMALL), S.members(spark, SF_SMALL), S.services(spark, SF_SMALL)
    A.index_members(member, tmp_dir)
    days = (S.ACTIVITY_FIRST_DAY, S.ACTIVITY_LAST_DAY)
    for q in ("#0000001", "90000", "Customer#000000012", "er", "no such"):
        plain = A.reachout_raw(forms, member, services, *days, include_pii=True, query=q)
        fast = A.reachout_raw(forms, member, services, *days, include_pii=True, query=q, member_index=tmp_dir)
        assert sorted(map(tuple, fast.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5), st.integers(2**40, 2**40 + 70_000))), max_size=40))
def test_bitmaps_count_distinct_ids(spark, rows):
    df = spark.createDataFrame(rows, "ag string, day int, id long")
    bits = B.id_bitmaps(df, ["ag", "day"], "id")
    got = {r.ag: r.n for r in B.distinct_ids(bits, ["ag"], "n").collect()}
    want = {}
    for ag, _, i in rows:
        if i is not None:
            want.setdefault(ag, set()).add(i)
    assert got == {k: len(v) for k, v in want.items()}
    days = {r.day: r.n for r in B.distinct_ids(bits, ["day"], "n").collect()}
    assert days == {d: len({i for _, e, i in rows if e == d and i is not None}) for d in {e for _, e, i in rows if i is not None}}


def test_bitmaps_refuse_text_ids(spark):
    with pytest.raises(TypeError, match="whole-number"):
        B.id_bitmaps(spark.createDataFrame([("a", "b")], "k string, id string"), ["k"], "id")


def test_window_accounts_from_kept_rows(spark, tmp_dir):
    """Distinct accounts of any window from one written table; fewer than the sum where an account returns."""
    from ledgerline.operators.merge import write_day_partitions

    forms, member = S.reachout_forms(spark, SF_SMALL), S.members(spark, SF_SMALL)
    bits, rows = A.account_bitmaps(forms, member, S.ACTIVITY_FIRST_DAY, None), A.created_activity(forms, member, S.ACTIVITY_FIRST_DAY, None)
    write_day_partitions(bits, os.path.join(tmp_dir, "bits"))
    kept = spark.read.schema(bits.schema).parquet(os.path.join(tmp_dir, "bits"))
    for lo, hi in ((dt.date(2024, 1, 3), dt.date(2024, 1, 3)), (dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (dt.date(2030, 1, 1), None)):
        got = {r.agent: (r.accts_sum, r.accts_distinct) for r in T.window_accounts(rows, kept, lo, hi).collect()}
        base = A.with_member(A.form_base(forms.filter(A.C.in_local_days("created_at", lo, hi, "UTC"))).filter("bk <> 'Other'"), member)
        want = {r.ag: r.n for r in base.groupBy("ag").agg(F.count_distinct("account_uid").alias("n")).collect()}
        want["ALL"] = base.agg(F.count_distinct("account_uid").alias("n")).first().n
        assert {k: v[1] for k, v in got.items()} == want
        assert all(s >= n for s, n in got.values())


def test_rows_without_an_agent_stay_beside_the_total(spark):
    rows = spark.createDataFrame([(None, 5), ("a", 1), (None, 2)], "ag string, n long")
    got = {r.agent: r.n for r in T.agent_totals(rows, {"n": F.col("n")}).collect()}
    assert got == {None: 7, "a": 1, "ALL": 8}
    assert [tuple(r) for r in T.agent_totals(rows.limit(0), {"n": F.col("n")}).collect()] == [("ALL", 0)]
