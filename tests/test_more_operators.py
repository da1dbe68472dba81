"""Sources, sinks and the operators that no query runs, on small tables."""

import json
import math
import os
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caresieve.operators import etl, images, learning, losses, prepare, profile, quality, replicates, schema, skew, spec
from caresieve.operators.quantiles import exact_quantiles
from caresieve.sources import files, sinks
from caresieve.streaming import incremental


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# ---- ids and pseudonyms


def test_pseudonyms_of_over_99999_patients_differ(spark):
    ids = spark.range(100_020).select(F.col("id").alias("p"))
    out = prepare.pseudonym_map(ids, "p").cache()
    assert out.select("new_id").distinct().count() == 100_020
    number = F.regexp_extract("new_id", r"^patient(\d+)_[A-Z]{5}$", 1)
    assert out.where(number.cast("long") == F.col("p") + 1).count() == 100_020
    assert {r.new_id[:13] for r in out.where("p in (0, 9999, 100000)").collect()} == {"patient00001_", "patient10000_", "patient100001"}
    assert "row_number" not in out._jdf.queryExecution().executedPlan().toString()  # ranks come from counts of ranges


def test_manifest_numbers_over_999(spark):
    listing = spark.range(1001).select(F.lit("p1").alias("patient"), F.lit("s").alias("series"), F.lpad(F.col("id").cast("string"), 4, "0").alias("path"), F.lit("a.DCM").alias("name"))
    out = sinks.rename_manifest(listing, spark.createDataFrame([("p1", "N")], "patient string, new_id string"))
    got = {r.source_path: r.target_path for r in out.collect()}
    assert len(set(got.values())) == 1001 and got["0000"] == "N/sample001_s/a.dcm" and got["1000"] == "N/sample1001_s/a.dcm"


def test_facts_and_procedures(spark):
    facts = etl.facts_of([spec.Variable("age", "int", target={"Concept_ID": "7"}, unit_concept_id=3), spec.Variable("sex", "str", cardinality=2, target={"Concept_ID": 8}), spec.Variable("other")])
    assert [(f.concept_id, f.number, f.text) for f in facts] == [(7, "age", None), (8, None, "sex")]
    visits = spark.createDataFrame([(1, 10, "b"), (1, 10, "a"), (2, 20, "c")], "person bigint, visit bigint, series string")
    out = etl.procedures(visits, "person", "visit", 102, ["visit", "series"], 5)
    assert rows(out, "procedure_occurrence_id") == [(6, 1, 102, 10, "a"), (7, 1, 102, 10, "b"), (8, 2, 102, 20, "c")]
    assert etl.procedure_concept({"4": ["CT"], "5": ["MRI", "CT"]}, "CT") == 4 and etl.procedure_concept({}, "CT") == 0


# ---- files


def test_two_headers_keep_rows_that_look_like_them(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('Patient ID;note;x\n;mg;cm\n;mg;cm\nPatient ID;note;x\np1;"two\nlines";1,5\n')
    df, units = files.read_two_headers(spark, str(path), multiline=True)
    assert units == {"Patient ID": "", "note": "mg", "x": "cm"}
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, [(None, "mg", "cm"), ("Patient ID", "note", "x"), ("p1", "two\nlines", "1.5")]))
    long = tmp_path / "long.csv"
    long.write_text("a;b\nkg;cm\n" + "kg;cm\n" * 3 + "".join(f"{i};{i},5\n" for i in range(20_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df, _ = files.read_two_headers(spark, str(long))
        assert df.rdd.getNumPartitions() > 5 and df.count() == 20_003 and df.where("a = 'kg'").count() == 3
        assert df.where("b = '19999.5'").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_written_two_headers_read_back(spark, tmp_path):
    df = spark.createDataFrame([("p2", "b;c"), ("p1", 'say "x"'), ("p3", None)], "`Patient ID` string, `odd;name` string")
    sinks.write_two_headers(df, str(tmp_path / "out"), {"odd;name": "u;v"}, order=["Patient ID"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text.splitlines()[:2] == ['Patient ID;"odd;name"', ';"u;v"'] and [x[:2] for x in text.splitlines()[2:]] == ["p1", "p2", "p3"]
    back, units = files.read_two_headers(spark, str(next((tmp_path / "out").glob("part-*"))))
    assert units["odd;name"] == "u;v" and [r[0] for r in back.collect()] == ["p1", "p2", "p3"] and back.first()[1] == 'say "x"'
    sinks.write_two_headers(df, str(tmp_path / "many"), parts=3)
    names = sorted((tmp_path / "many").glob("part-*"))
    assert "".join(p.read_text() for p in names).startswith("Patient ID;")


def test_vocabularies_documents_and_lists(spark, tmp_path):
    kind = "concept_id bigint, concept_name string, valid_start_date date"
    (tmp_path / "v.csv").write_text('concept_id\tconcept_name\tvalid_start_date\n7\tan "odd" name\t20240229\n')
    want = rows(files.read_vocabulary(spark, str(tmp_path / "v.csv"), kind))
    assert [(i, n, str(d)) for i, n, d in want] == [(7, 'an "odd" name', "2024-02-29")]
    lines = spark.createDataFrame([('7\tan "odd" name\t20240229',)], "value string")
    assert rows(files.vocabulary_rows(lines, kind)) == want
    document = {"clinical data": {"Patient ID": {}, "Age": {"position": 1, "type": "int", "ground-truth": "yes"}}}
    (tmp_path / "p.json").write_text(json.dumps(document, indent=1))
    for session in (None, spark):
        assert files.read_json(str(tmp_path / "p.json"), session) == document
        assert spec.load_protocol(str(tmp_path / "p.json"), session).ground_truth.name == "Age"
    (tmp_path / "l.txt").write_text(" one \n\n  \ntwo\n")
    assert rows(files.read_lines(spark, str(tmp_path / "l.txt")), "line") == [("one",), ("two",)]
    for d in ("p1/ct", "p2/mr", "Reports/x"):
        (tmp_path / "tree" / d).mkdir(parents=True)
        (tmp_path / "tree" / d / "a.dcm").write_bytes(b"123")
    listed = files.list_files(spark, str(tmp_path / "tree"))
    assert rows(listed.select("patient", "series", "name", "length"), "patient") == [("p1", "ct", "a.dcm", 3), ("p2", "mr", "a.dcm", 3)]


def test_jdbc_falls_back_to_the_next_host(spark, tmp_path):
    good = f"jdbc:derby:{tmp_path}/db"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.createDataFrame([(1, "x")], "k int, v string").write.format("jdbc").options(url=good + ";create=true", dbtable="t", **driver).save()
    out = files.read_jdbc(spark, [f"jdbc:derby:{tmp_path}/absent", good], "t", **driver)
    assert [tuple(r) for r in out.collect()] == [(1, "x")]
    with pytest.raises(files.SourceError, match="no host"):
        files.read_jdbc(spark, [f"jdbc:derby:{tmp_path}/absent"], "t", **driver)


def test_catalog_tables_appends_and_resumed_phases(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS cdm_test LOCATION '{tmp_path}/cdm'")
    try:
        made = schema.create_all(spark, "cdm_test")
        assert made == sorted(schema.TABLES) and rows(files.list_tables(spark, "cdm_test").select("name")) == [(x,) for x in made]
        person = schema.conform(spark.createDataFrame([(1, 0, 1990, 0, 0)], "person_id bigint, gender_concept_id int, year_of_birth int, race_concept_id int, ethnicity_concept_id int"), "person")
        sinks.append_table(person, "cdm_test.person")
        assert spark.table("cdm_test.person").count() == 1
    finally:
        spark.sql("DROP DATABASE cdm_test CASCADE")
    found = spark.createDataFrame([(2, "E201", "error", "a", 3, True), (3, "E301", "error", None, 0, False)], quality.RESULT)
    sinks.append_results(found, str(tmp_path / "results"), "here", "clinical")
    sinks.append_results(found, str(tmp_path / "results"), "there", "clinical")
    assert spark.read.parquet(str(tmp_path / "results")).where("family = 'clinical'").count() == 4
    assert rows(sinks.report(found)) == [("phase 2: error E201 (3)",)]
    assert quality.run_resumed(2, [(3, "c"), (1, "a"), (2, "b")]) == [(3, "c")]
    assert incremental.run_phases(spark, str(tmp_path / "s"), [("a", lambda: spark.range(1))]) == ["a"]


def test_synthetic_matrix_separates_its_classes(spark):
    t = files.synthetic_genomics(spark, 20, 200, range(10, 12))
    means = {r.label: r.v for r in t.where("feature in (10, 11)").groupBy("label").agg((F.sum("value") / 20).alias("v")).collect()}
    assert means[1] > 1 and means.get(0, 0) < 0.5 and rows(t, "sample", "feature") == rows(files.synthetic_genomics(spark, 20, 200, range(10, 12)), "sample", "feature")


# ---- checks


def test_structure_codes(spark):
    listing = spark.createDataFrame([("clinical/other.csv",), ("genomics/mapping.csv",), ("genomics/sample_1.json",)], "path string")
    want = {"clinical": "table.csv", "images": "", "genomics": "mapping.csv"}
    assert rows(quality.input_faults(listing, want), "code") == [("E001", "images"), ("E002", "clinical")]
    assert rows(quality.input_faults(listing.where("path not like '%sample%'"), {"genomics": "mapping.csv"})) == [("E006", "genomics")]
    assert rows(quality.input_faults(listing.limit(0), want), "part") == [("E001", "clinical"), ("E001", "genomics"), ("E001", "images")]
    assert quality.header_faults(["Patient ID;Age", ";years"]) == [] and quality.header_faults(["Patient ID;Age"]) == ["E003"]
    assert quality.header_faults(["x;Age", "1;30"]) == ["E003", "E004"]
    assert quality.order_faults(["a", "b", "c"], ["a", "c", "b"]) == [(2, "b", "c"), (3, "c", "b")]
    assert spec.local_config_faults({"clinical data": {"file name": "a.xlsx"}, "patients list": "b.csv"}) == ["clinical data: a.xlsx is no .csv file"]


def test_validation_has_every_code_and_stops_early(spark):
    variables = (
        spec.Variable("a", "int", 1, unit="mg", ranges=(">=0",), variability=("<10%",)),
        spec.Variable("s", "str", 2, cardinality=2, levels=("x", "y"), unbalance=("<30%",)),
        spec.Variable("t", "str", 3, cardinality=2, levels=("0", "1"), ground_truth=True, unbalance=("<30%",)),
    )
    p = spec.Protocol(variables, missing=-999)
    df = spark.createDataFrame([("p1", "1", "x", "0"), ("p2", "50", "x", "0"), ("p3", "50", "x", "0"), ("p4", "-7", "z", "0")], "id string, a string, t string, s string")
    df = df.select("id", "a", F.col("t").alias("s"), F.col("s").alias("t"))
    known = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "id string")
    found = {(r.code, r.variable): r.n for r in quality.validate(df, p, "id", units={"a": "kg", "s": ""}, known=known).where("present").collect()}
    assert found == {("E302", "a"): 1, ("E401", "a"): 1, ("W401", "a"): 1, ("E501", "s"): 1, ("W501", "t"): 1, ("W901", "s"): 1, ("W701", None): 1, ("E801", None): 1} | {k: v for k, v in found.items() if k[0] == "E501" and k[1] == "s"}
    swapped = quality.validate(df.select("id", "s", "a", "t"), p, "id").where("code = 'E303'").first()
    assert swapped.n == 2
    jobs = []
    tracked = df.withColumn("a", F.col("a"))
    real = quality.count_replicates
    try:
        quality.count_replicates = lambda *x, **k: (jobs.append(1), real(*x, **k))[1]
        early = quality.validate(tracked, p, "id", "failfast")
        assert {r.phase for r in early.collect()} == {2, 3, 4} and not jobs
        assert quality.validate(tracked.where("a > 0"), p, "id", "failfast").agg(F.max("phase")).first()[0] >= 5
    finally:
        quality.count_replicates = real


def test_slice_sizes_planes_and_views(spark):
    s = spark.createDataFrame(
        [("p", "s", 0, 2, 2, 1, 3, 16, 24, False), ("p", "s", 1, 2, 2, 1, 3, 16, 23, False), ("p", "s", 2, 2, 2, 1, 3, 16, 7, True)],
        "patient_id string, series_id string, slice_idx int, h int, w int, frames int, samples int, bits int, n_bytes int, compressed boolean",
    ).withColumn("pixels", F.array(F.lit(1.0), F.lit(2.0)))
    assert rows(images.slice_checks(s, 1, 1)) == [("E3201", "p", "s", 1)]
    flat = spark.createDataFrame([(1, "L", "AP"), (2, "R", "AP"), (3, " ", "AP"), (4, "L", None)], "k int, patient_orientation string, view_position string")
    assert rows(images.view_faults(flat, ["k"], "L", "AP"), "k") == [("E3301", 2), ("W3301", 3), ("W3301", 4)]
    cosines = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]), (2, [0.0, 1.0, 0.0, 0.0, 0.0, 1.0]), (3, None)], "k int, cosines array<double>")
    assert rows(images.plane_faults(cosines, ["k"]), "k") == [("E3301", 2, "Sagittal"), ("E3301", 3, "Unknown")]


def test_label_tables(spark):
    lines = spark.createDataFrame([(1, 1, "a;b"), (1, 2, "c;d"), (2, 1, "a,b"), (2, 2, "c,d,e"), (3, 1, "only"), (4, 1, "  "), (5, 1, "a|b")], "k int, place int, line string")
    assert rows(images.label_table_faults(lines, ["k"]), "k") == [("E2202", 2, 3), ("E2202", 3, 1), ("E2202", 4, 0)]
    series = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    found = spark.createDataFrame([(1, "l.CSV"), (2, "a.csv"), (2, "b.csv"), (2, "x.dcm")], "k int, name string")
    assert rows(images.label_file_faults(series, found, ["k"], "name"), "k") == [("E2201", 2, 2), ("E2201", 3, 0)]


def test_series_order_first_series_and_labels_that_follow(spark):
    s = spark.createDataFrame([("p", "b", 0, 5.0), ("p", "b", 1, 3.0), ("p", "a", 0, 1.0)], "patient_id string, series_id string, slice_idx int, z double")
    assert rows(images.first_series(s).select("series_id")) == [("a",)]
    ordered = images.order_slices(s, ["patient_id", "series_id"])
    assert {(r.series_id, r.slice_idx, r.place, r.reordered) for r in ordered.collect()} == {("b", 1, 1, True), ("b", 0, 2, True), ("a", 0, 1, False)}
    labels = spark.createDataFrame([("p", "b", 0, "first"), ("p", "b", 1, "second")], "patient_id string, series_id string, slice_idx int, label string")
    assert rows(images.follow_slices(labels, ordered, ["patient_id", "series_id"]).select("place", "label"), "place") == [(1, "second"), (2, "first")]


# ---- statistics


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_against_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    given = [(k, float(v)) for k in ("a", "b", "c") for v in (rng.integers(0, 5, 300) if k == "a" else rng.normal(size=701))] + [("one", 3.0), ("none", None), ("nan", math.nan)]
    ps = [0.0, 0.01, 0.25, 0.5, 0.77, 1.0]
    got = {r.k: r.quantiles for r in exact_quantiles(spark.createDataFrame(given, "k string, v double").repartition(7), ["k"], "v", ps).collect()}
    held = defaultdict(list)
    for k, v in given:
        if v is not None and v == v:
            held[k].append(v)
    assert set(got) == set(held)
    for k, vs in held.items():
        assert got[k] == pytest.approx(np.quantile(vs, ps).tolist())


def test_profiles_hold_no_column_in_one_task(spark):
    df = spark.range(1000).select(F.col("id").alias("n"), F.lit("t").alias("t"), F.lit(None).cast("double").alias("e"))
    out = {r.variable: r for r in profile.profile(df).collect()}
    assert (out["n"].q1, out["n"].median, out["n"].q3) == (249.75, 499.5, 749.25) and out["t"].median is None and out["e"].median is None and out["e"].missing == 1000
    assert "percentile" not in profile.profile(df)._jdf.queryExecution().optimizedPlan().toString()


def test_knee_of_each_series(spark):
    a, b = [float(x) for x in range(1000)], [float(x) for x in range(980)] + [10.0 ** (4 + i / 5) for i in range(20)]
    df = spark.createDataFrame([("a", 0, a), ("b", 0, b[:500]), ("b", 1, b[500:])], "s string, i int, pixels array<double>")
    got = {(r.s, r.i): max(r.pixels) for r in images.knee_clip(df, ["s"]).collect()}
    steps = [0.95 + i / 10_000 for i in range(500)]
    for s, v in (("a", a), ("b", b)):
        curve = np.quantile(v, steps)
        assert max(x for (k, _), x in got.items() if k == s) == pytest.approx(min(max(v), curve[images.knee(curve.tolist())]))


def plain_average_precision(t, p, ignore, least):
    t, p = np.array(t), np.array(p)
    for x in (t, p):
        for v, n in zip(*np.unique(x, return_counts=True)):
            if least and n < least:
                x[x == v] = ignore
    points = []
    for limit in images.OVERLAPS:
        wrong, missed, right = set(p.tolist()) - {ignore}, set(t.tolist()) - {ignore}, 0
        for v in sorted(set(p.tolist()) - {ignore}):
            labels, n = np.unique(t[p == v], return_counts=True)
            best = labels[np.argmax(n)]
            if ((p == v) & (t == best)).sum() / ((p == v) | (t == best)).sum() > limit:
                wrong.discard(v)
                if best != ignore:
                    right += 1
                    missed.discard(best)
        points.append((right / (right + len(missed)) if right + len(missed) else 0.0, right / (right + len(wrong)) if right + len(wrong) else 0.0))
    points = [(0.0, 0.0), *sorted(points, key=lambda x: x[0]), (1.0, 0.0)]
    return sum((points[i][0] - points[i - 1][0]) * max(q for _, q in points[i:]) for i in range(1, len(points)))


def test_average_precision_against_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    cases, given = {}, []
    for k in range(12):
        t = rng.integers(-1, 4, 300)
        p = np.where(rng.random(300) < 0.05 * (k + 1), rng.integers(-1, 6, 300), t)
        cases[k] = plain_average_precision(t, p, -1, 8)
        given += [(k, int(a), int(b)) for a, b in zip(t, p)]
    got = {r.k: r.average_precision for r in images.average_precision(spark.createDataFrame(given, "k int, t int, p int"), "t", "p", -1, 8, ["k"]).collect()}
    assert got == pytest.approx(cases)
    whole = images.average_precision(spark.createDataFrame([x for x in given if x[0] == 0], "k int, t int, p int"), "t", "p", -1, 8)
    assert whole.first()[0] == pytest.approx(cases[0])


def test_vectors_with_black_corners_fall_in_many_cells(spark):
    rng = np.random.default_rng(4)
    vectors = [[0.0] * 30 + rng.normal(size=34).tolist() for _ in range(200)]
    vectors += [[x + 1e-5 for x in v] for v in vectors[:20]] + [vectors[0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "k bigint, v array<double>")
    assert sorted(rows(replicates.close_pairs(df, "k", "v").select("a", "b"))) == [(i, 200 + i) for i in range(20)]
    cells = df.select(*[F.floor(replicates._projection(F.col("v"), i) / replicates.DISTANCE).alias(f"c{i}") for i in range(3)])
    assert cells.distinct().count() > 190


def test_squared_loss_reaches_least_squares(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    y = x @ [1.5, -0.5] + 0.25
    df = spark.createDataFrame([("a" if i % 3 else "b", float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "site string, u double, v double, y double").cache()
    m = learning.train_linear(df, "site", ["u", "v"], "y", rounds=60, rate=0.3)
    assert (*m.weights, m.bias) == pytest.approx((1.5, -0.5, 0.25), abs=1e-3)
    strong = learning.train_linear(df, "site", ["u", "v"], "y", rounds=30, rate=0.1, l1=0.3)
    assert sum(map(abs, strong.weights)) < 1.8
    with pytest.raises(ValueError, match="isn't known"):
        learning.train_rounds(df, "site", ["u"], "y", "hinge")


def test_losses_against_numpy(spark):
    given = [(0, [0.7, 0.2, 0.1]), (2, [0.1, 0.1, 0.8]), (1, [0.5, 0.4, 0.1])]
    df = spark.createDataFrame(given, "t int, p array<double>")
    w = [1.0, 2.0, 0.5]
    assert losses.weighted_cross_entropy(df, "t", "p", w).first()[0] == pytest.approx(sum(-w[t] * math.log(p[t]) for t, p in given) / sum(w[t] for t, _ in given))
    long = [(c, float(t == c), p[c]) for t, p in given for c in range(3)]
    per = {c: [(a, b) for k, a, b in long if k == c] for c in range(3)}
    weight = {c: 1 / max(sum(a for a, _ in x) ** 2, 1e-6) for c, x in per.items()}
    want = 1 - 2 * sum(weight[c] * sum(a * b for a, b in x) for c, x in per.items()) / sum(weight[c] * sum(a + b for a, b in x) for c, x in per.items())
    assert losses.generalised_dice_loss(spark.createDataFrame(long, "c int, a double, b double"), "c", "a", "b").first()[0] == pytest.approx(want)
    assert [r.onehot for r in prepare.one_hot_pixels(df, "t", 3).collect()] == [[1, 0, 0], [0, 0, 1], [0, 1, 0]]
    turned = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([3.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert images.inverse_angular_error(turned, "a", "b").first()[0] == pytest.approx(1 / (math.pi / 2 + math.acos(0.999999**2)))


def test_further_losses_and_mean_iou(spark):
    rng = np.random.default_rng(9)
    x, t, w = rng.normal(size=(40, 3)), rng.integers(-1, 3, 40), rng.random(40)
    df = spark.createDataFrame([(int(a), [float(v) for v in b], float(c)) for a, b, c in zip(t, x, w)], "t int, x array<double>, w double")
    log_p = x - np.log(np.exp(x).sum(axis=1, keepdims=True))
    cw = [1.0, 2.0, 0.5]
    want = sum(-w[i] * cw[t[i]] * log_p[i, t[i]] for i in range(40) if t[i] >= 0) / 120
    assert losses.pixel_cross_entropy(df, "t", "x", "w", cw, -1).first()[0] == pytest.approx(want)
    d = np.abs(x[:, 0] - x[:, 1])
    flat = spark.createDataFrame([(float(a), float(b)) for a, b in x[:, :2]], "a double, b double")
    assert losses.smooth_l1(flat, "a", "b", 0.7).first()[0] == pytest.approx(np.where(d < 0.7, d * d / 1.4, d - 0.35).mean())
    u, v = x / np.linalg.norm(x, axis=1, keepdims=True), np.roll(x, 1, axis=0)
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    angles = np.arccos((u * v).sum(axis=1) * 0.999999**2)
    pairs = spark.createDataFrame([(a.tolist(), b.tolist(), float(c)) for a, b, c in zip(x, np.roll(x, 1, axis=0), w)], "a array<double>, b array<double>, w double")
    assert losses.square_angular(pairs, "a", "b", "w").first()[0] == pytest.approx((angles**2 * w).sum())
    p = rng.integers(0, 3, 40)
    keep = t >= 0
    iou = [((t == c) & (p == c) & keep).sum() / max(1, (((t == c) | (p == c)) & keep).sum()) for c in range(3)]
    pixels = spark.createDataFrame([(int(a), int(b)) for a, b in zip(t, p)], "t int, p int")
    assert images.mean_iou(pixels, "t", "p", 3, -1).first()[0] == pytest.approx(np.mean(iou))
    assert images.mean_iou(pixels, "t", "p", 3, -1, (0,)).first()[0] == pytest.approx(np.mean(iou[1:]))


def test_volumes_turn_on_three_axes(spark):
    c = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]), (2, [-1.0, 0.0, 0.0, 0.0, 1.0, 0.0]), (3, [1.0, 0.0, 0.0, 0.0, -1.0, 0.0]), (4, [-1.0, 0.0, 0.0, 0.0, -1.0, 0.0])], "k int, c array<double>")
    assert rows(c.select("k", images.lps_flips(F.col("c"))), "k") == [(1, ""), (2, "ri"), (3, "ai"), (4, "ra")]
    s = spark.createDataFrame([("a", i, 1, 2, [float(i), 9.0], "ri") for i in range(3)], "series string, slice_idx int, h int, w int, pixels array<double>, flips string")
    assert rows(images.to_lps(s, series=["series"]).select("slice_idx", "pixels"), "slice_idx") == [(0, [9.0, 2.0]), (1, [9.0, 1.0]), (2, [9.0, 0.0])]


def test_slices_labels_and_check_files_are_written(spark, tmp_path):
    s = spark.createDataFrame([("p", 1, [2.0]), ("p", 0, [1.0]), ("q", 0, [3.0])], "series string, slice_idx int, pixels array<double>")
    sinks.write_slices(s, str(tmp_path / "s"), ["series"])
    assert rows(spark.read.parquet(str(tmp_path / "s/series=p")).select("slice_idx")) == [(0,), (1,)]
    sinks.write_labels(s.withColumn("y", F.lit("ill")), str(tmp_path / "l"), ["series"], "slice_idx", "y")
    assert next((tmp_path / "l/series=q").glob("*.csv")).read_text() == "slice,label\n0,ill\n"
    found = spark.createDataFrame([(2, "E201", "error", "a", 3, True), (2, "E201", "error", "b", 1, True), (3, "E301", "error", None, 0, False)], quality.RESULT)
    sinks.write_check_file(found, str(tmp_path / "c"), {"E201": "a value is missing"})
    assert [(r.code, r.n, r.description) for r in spark.read.json(str(tmp_path / "c")).collect()] == [("E201", 4, "a value is missing")]


def test_a_long_chain_is_one_component_and_leaves_no_tables(spark, tmp_path):
    """Size guesses of joins multiply over rounds; tables read again have their own size, so late rounds take no longer."""
    from caresieve.operators.graph import components

    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        chain = spark.range(1, 1200).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
        assert components(chain).agg(F.count(F.lit(1)), F.max("root")).first() == (1200, 0)
        assert not [d for _, dirs, _ in os.walk(tmp_path) for d in dirs if d.startswith("steps-")]
    finally:
        spark.sparkContext.setCheckpointDir(before.removeprefix("file:") if before else str(tmp_path))


# ---- sessions and the entry


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        _conf = type("C", (), {"set": lambda *a: None})()
        getCheckpointDir = staticmethod(lambda: None)

    class Frame:
        sparkSession = type("S", (), {"sparkContext": Context, "conf": type("C", (), {"get": lambda self, k, d=None: d})()})()

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        skew.cut(Frame())


def test_salts_follow_the_count_of_a_key(spark):
    given = spark.range(50_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    facts = given.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = skew.salted_join(given, facts, ["k"], "n", "v", hot_rows=1000)
    assert out.count() == 50_000 and Counter(r.k for r in out.where("k < 2").select("k").collect()) == {0: 25_000, 1: 1_000}
    assert skew.free_names(["Salt", "x"], "salt", "x", "y") == ["salt_", "x_", "y"]


def test_the_entry_works_without_the_corpus_part(monkeypatch):
    import __spark_entry__ as entry

    class Refusing:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline":
                raise ImportError("no tiktoken here", name="tiktoken")

    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    monkeypatch.setattr(sys, "meta_path", [Refusing(), *sys.meta_path])
    with pytest.warns(UserWarning, match="tiktoken"):
        names = entry.queries()
    assert len(names) > 100 and not any(n.startswith("op") and n[2].isdigit() for n in names)
    assert os.path.basename(entry.__file__) == "__spark_entry__.py"
