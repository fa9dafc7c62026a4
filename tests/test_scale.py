"""What the lab queries read, shuffle and store, on rows written out by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests import inline
from trialguard.operators import cleaning, conformance, keys, rules, sdtm
from trialguard.plans import catalog
from trialguard.sources import fixtures


def _tables(spark, folder) -> str:
    """Ten subjects with twenty orders and sixty items."""
    spark.createDataFrame([(k, k % 8) for k in range(10)], "c_custkey long, c_nationkey int").write.parquet(f"{folder}/customer.parquet")
    orders = [(n, n % 10, "FO"[n % 2], "1-URGENT") for n in range(20)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    items = [(n % 20, n * 7, n % 5, n // 20 + 1, float(n % 50), n + 0.5) for n in range(60)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    spark.createDataFrame(items, names).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_items_are_joined_once_and_by_order(spark, tmp_path):
    plan = fixtures.raw_lb(spark, _tables(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join Inner" in line]
    assert "l_orderkey" in joins[0] and "o_custkey" in joins[1]


def test_stored_rows_hold_no_value_twice(spark):
    raw = inline.raw(spark, inline.LB, [{"SUBJID": "1", "VISIT": None}, {"SUBJID": "2", "LBDT": "bad"}])
    dm = cleaning.flag_dm(inline.raw(spark, inline.DM, [{"SUBJID": "1"}, {"SUBJID": "2"}])).clean
    flagged = cleaning.flag_lb(raw, dm)
    assert "_c_RECNO" not in flagged.essential.columns
    again = cleaning.of_stored("lb", flagged.essential)
    for view in ("clean", "clean_with_subject", "quarantine"):
        assert getattr(again, view).collect() == getattr(flagged, view).collect()


def test_baselines_without_numbers(spark):
    rows = [
        {"SUBJID": s, "LBTESTCD": t, "LBDT": d, "VISITNUM": v, "LBORRES": x}
        for s in "12" for t in ("ALT", "AST")
        for d, v, x in (("2025-01-09", "2", "50"), ("2025-01-09", "1", "20"), ("2025-01-09", "1", "30"), ("2025-01-11", "3", "5"), ("2025-01-08", "1", "7"))
    ] + [{"SUBJID": "1", "LBTESTCD": "BILI", "LBORRES": "<5"}]
    dm = cleaning.flag_dm(inline.raw(spark, inline.DM, [{"SUBJID": "1"}, {"SUBJID": "2"}]))
    clean, domain = cleaning.flag_lb(inline.raw(spark, inline.LB, rows), dm.clean).clean_with_subject, sdtm.build_dm(dm.clean)
    more = (sdtm.BASE_VALUE, sdtm.BASE_INDICATOR)
    both = [sdtm.lab_domain(f(clean, domain), *more).drop("LBSEQ") for f in (sdtm.lab_rows, sdtm.unnumbered_lab_rows)]
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))
    assert both[1].where("LBBLFL = 'Y'").count() == 4 and both[1].where("_BASE IS NULL").count() == 1
    assert "Window" not in both[1]._jdf.queryExecution().optimizedPlan().toString()


def test_lab_tables_store_neither_lb_nor_adlb(spark, tmp_path):
    at = _tables(spark, tmp_path)
    catalog.QUERIES["edish_points"](spark, at).collect()
    store = catalog.StoredStudy(spark, at).store
    assert store.mark("profile/labs") and store.mark("flagged/lb")
    assert not store.mark("sdtm/lb") and not store.mark("adam/adlb")


def test_only_crowded_cells_are_cut_into_grains(spark, monkeypatch):
    """Numbers are those of the grains of all rows; a subject or test of few rows is one grain, a crowded one is cut."""
    monkeypatch.setattr(keys, "CROWDED", 100)
    n = 6000
    rows = spark.range(n).select(
        F.col("id").alias("RECNO"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 300)).alias("USUBJID"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") * 7 % 3).cast("int")).alias("DAY"), F.concat(F.lit("t"), F.col("id") % 3).alias("TERM"),
    )
    for order, cell in ((["DAY", "TERM"], ["USUBJID"]), (["TERM", "DAY"], ["USUBJID", "TERM"])):
        many = keys.crowded(rows, cell)
        df, grain = keys.cells_of(rows, ["USUBJID"], order, many)
        sizes = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")).groupBy("USUBJID").agg(F.count(F.lit(1)).alias("grains"), F.max("n").alias("n"))
        cells = rows.groupBy("USUBJID").agg(F.countDistinct(*cell).alias("cells"))
        few = sizes.where("USUBJID <> 'hot'").join(cells, "USUBJID")
        assert few.count() == 150 and few.where("grains <> cells").count() == 0
        hot = sizes.where("USUBJID = 'hot'").first()
        assert hot.grains > 3 and hot.n <= 1024
        plain, counted = (sorted(keys.sequence(rows, ["USUBJID"], order, "SEQ", m).select("RECNO", "SEQ").collect()) for m in (None, many))
        assert plain == counted and len(plain) == n


def test_stored_labs_are_numbered_as_others(spark, monkeypatch):
    rows = [
        {"SUBJID": s, "LBTESTCD": t, "LBDT": d, "VISITNUM": v, "LBORRES": x}
        for s in "12" for t in ("ALT", "AST") if s + t != "2AST"
        for d, v, x in (("2025-01-09", "2", "50"), ("2025-01-09", "1", "20"), ("2025-01-09", "1", "30"), ("2025-01-11", "3", "<5"), ("2025-01-08", "1", "7"))
    ]
    dm = cleaning.flag_dm(inline.raw(spark, inline.DM, [{"SUBJID": "1"}, {"SUBJID": "2"}])).clean
    clean, domain = cleaning.flag_lb(inline.raw(spark, inline.LB, rows), dm).clean_with_subject, sdtm.build_dm(dm)
    found = []
    for stored, limit in ((False, 100), (True, 100), (True, 1), (True, 6)):
        monkeypatch.setattr(keys, "CROWDED", limit)
        found.append(sorted(map(str, sdtm.build_lb_with_baseline(clean, domain, stored).collect())))
    assert len(found[0]) == 15 and all(f == found[0] for f in found)


def test_hits_are_worked_out_once_for_counts_and_examples(spark):
    raw = inline.raw(spark, inline.LB, [{"SUBJID": str(i % 9), "LBDT": "bad"} for i in range(40)] + [{"SUBJID": ""}, {"SUBJID": None}])
    dm = cleaning.flag_dm(inline.raw(spark, inline.DM, [{"SUBJID": str(i)} for i in range(8)])).clean
    found = cleaning.flag_lb(raw, dm).findings
    got = {r.rule_id: (r["count"], r.examples) for r in found.collect()}
    assert got == {"LB-R01": (6, ", 8"), "LB-R02": (36, "0, 1, 2, 3, 4")}
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("Generate explode") == 1


def test_examples_pass_over_missing_ids(spark):
    hits = spark.createDataFrame([("a", None, 2), ("a", "x", 1), *(("b", f"{i}", 1) for i in range(7)), ("b", None, 1), ("c", None, 3)], "key string, _id string, _w long")
    found = rules.summarize_hits(hits, [rules.Rule(k, "LB", "ERROR", k) for k in "abc"])
    assert {r.rule_id: (r["count"], r.examples) for r in found.collect()} == {"a": (3, "x"), "b": (8, "0, 1, 2, 3, 4"), "c": (3, "")}


def test_only_subjects_are_looked_up_in_dm(spark):
    """SD0005 counts rows, those without a subject too, but the join to DM is of one row a subject."""
    dm = inline.dataset(spark, "DM", [{"USUBJID": u} for u in ("1", "1", "2")])
    ae = inline.dataset(spark, "AE", [{"USUBJID": u, "AESEQ": 1} for u in ("1", "2", "3", "3", None)])
    found = conformance.check_sdtm(spark, {"DM": dm, "AE": ae})
    hit = [r for r in found.collect() if r.rule_id == "SD0005"]
    assert [(r["domain"], r["count"], r.examples) for r in hit] == [("AE", 3, "3")]
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    under = [plan[k + 1] for k, line in enumerate(plan) if "Join LeftOuter" in line and "USUBJID" in line]
    assert under and all("Aggregate [USUBJID" in line for line in under)


def _lab_study(spark) -> catalog.Study:
    """Three subjects of 2 to 12 labs, labs without a known subject, and some that are quarantined."""
    days = (("2025-01-09", "2", "50"), ("2025-01-09", "1", "20"), ("2025-01-09", "1", "30"), ("2025-01-11", "3", "<5"), ("2025-01-08", "1", "7"), ("bad", "1", "9"))
    rows = [
        {"SUBJID": s, "LBTESTCD": t, "LBDT": d, "VISITNUM": v, "LBORRES": x}
        for s, tests in (("1", ("AST", "ALT")), ("2", ("BILI",)), ("gone", ("ALT", "AST"))) for t in tests for d, v, x in days
    ]
    rows += [{"SUBJID": "3"}, {"SUBJID": "3", "VISITNUM": "x"}, *({"SUBJID": None} for _ in range(7))]
    study = catalog.Study(spark, "")
    study.raw = {"dm": inline.raw(spark, inline.DM, [{"SUBJID": s} for s in "123"]), "lb": inline.raw(spark, inline.LB, rows)}
    return study


def test_labs_of_usual_subjects_are_shuffled_for_the_lookup_alone(spark):
    """Where no subject is crowded, labs are dealt out by subject to meet DM and stay there while they are numbered."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = _lab_study(spark).sdtm_lb
        assert df.count() and len(df.collect()) == 16
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [line for line in final if "Exchange hashpartitioning" in line]
    assert len(dealt) == 4, dealt  # labs, DM, and in DM its rows and their first copies
    assert not any("LBTESTCD" in line for line in dealt) and sum("concat" in line for line in dealt) == 1


def test_only_rows_of_known_crowded_subjects_are_set_apart(spark, monkeypatch):
    monkeypatch.setattr(keys, "CROWDED", 6)
    study = _lab_study(spark)
    usual, large, known = cleaning.crowded_apart(study.raw["lb"], study.dm.clean)
    assert {(r.SUBJID, r["count"]) for r in usual.groupBy("SUBJID").count().collect()} == {("2", 6), ("3", 2)}
    assert {(r.SUBJID, r["count"]) for r in large.groupBy("SUBJID").count().collect()} == {("1", 12)}
    assert [r.SUBJID for r in known.collect()] == ["1"]


def test_labs_of_crowded_and_usual_subjects_are_numbered_alike(spark, monkeypatch):
    study = _lab_study(spark)
    expected = sdtm.build_lb(study.lb.clean_with_subject, study.sdtm_dm)
    assert expected.where("LBBLFL = 'Y'").count() == 4
    expected = sorted(map(str, expected.collect()))
    for limit in (100, 6, 1, 0):
        monkeypatch.setattr(keys, "CROWDED", limit)
        df = _lab_study(spark).sdtm_lb
        assert sorted(map(str, df.collect())) == expected and df.columns == list(study.sdtm_lb.columns), limit
