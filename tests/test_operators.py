"""Behaviour on small tables; each decision that differs from a plain reading is named in its test."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from caresieve.functions.predicates import SpecError
from caresieve.operators import cohort, covariance, etl, images, learning, moments, prepare, quality, replicates, schema, similarity
from caresieve.operators.graph import components
from caresieve.operators.spec import Variable, faults, id_column, protocol_from
from caresieve.sources import files, sinks
from caresieve.streaming import incremental

PROTOCOL = {
    "clinical data": {
        "Patient ID": {},
        "Missing Values": {"expected_value": -999, "other_possible_values": ["NA", "?"]},
        "Age": {"position": 1, "type": "int", "unit_of_measure": "years", "condition": {"expected_range": [">=0", "<=120"], "expected_variability": ["<80%"]}},
        "Sex": {"position": 2, "type": "str", "cardinality": 2, "expected_values": ["F", "M"], "synonymous_values": {"F": ["female"], "M": ["male"]}, "order": 0, "coding": {"F": 0, "M": 1}, "Concept_IDs": [8532, 8507]},
        "Grade": {"position": 3, "type": "str", "cardinality": 3, "expected_values": ["low", "mid", "high"], "order": 1, "coding": {"low": 0, "mid": 1, "high": 2}},
        "Visit1": {"position": 4, "type": "str", "date_format": "%d/%m/%Y"},
        "Visit2": {"position": 5, "type": "str", "date_format": "%d/%m/%Y"},
        "Outcome": {"position": 6, "type": "str", "cardinality": 2, "expected_values": ["0", "1"], "ground-truth": "yes"},
        "Transformations": {"var1": "Visit1", "var2": "Visit2", "transformed_variables": {"Days": {"formula": "var2 - var1", "unit_of_measure": "days"}}},
    }
}
CSV = """Patient ID;Age;Sex;Grade;Visit1;Visit2;Outcome
;years;;;;;
p1;34;female;low;01/02/2024;11/02/2024;1
p2;-999;M;-999;1/3/2024;5/3/2024;0
p3;130;X;mid;31/02/2024;01/03/2024;1
p4;130;X;mid;31/02/2024;01/03/2024;1
"""


@pytest.fixture
def clinical(spark, tmp_path):
    path = tmp_path / "clinical.csv"
    path.write_text(CSV)
    return files.read_two_headers(spark, str(path))


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_fixture_codes(clinical, spark):
    df, units = clinical
    p = protocol_from(PROTOCOL)
    assert units["Age"] == "years" and quality.unit_faults(p, units) == []
    found = {(r.code, r.variable): r.n for r in quality.validate(df, p, "Patient ID").collect()}
    assert found["E401", "Age"] == 2
    assert found["E601", "Visit1"] == 1 and found["E601", "Visit2"] == 0
    assert found["E501", "Sex"] == 1 and found["E501", "Grade"] == 1
    assert found["W701", None] == 1
    assert found["E301", None] == 0


def test_replicates_ignore_the_id_unless_asked(clinical):
    df, _ = clinical
    by_values = quality.number_replicates(df, "Patient ID", ["Patient ID"])
    assert rows(by_values.where("copy > 1").select("Patient ID")) == [("p4",)]
    assert quality.number_replicates(df, "Patient ID", ["Patient ID"], scope="row").where("copy > 1").count() == 0


def test_failfast_stops_after_the_first_faulty_phase(clinical):
    df, _ = clinical
    out = quality.validate(df, protocol_from(PROTOCOL), "Patient ID", mode="failfast")
    assert {r.phase for r in out.collect()} == {2, 3, 4}


def test_variability_leaves_the_sentinel_out_unless_asked(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (-999.0,)], "x double")
    assert quality.variability(df, ["x"], -999).first().cv == pytest.approx(50)
    assert quality.variability(df, ["x"], -999, include_sentinel=True).first().cv < 0
    assert quality.variability(df, ["x"], -999, sample=True).first().cv == pytest.approx(100 * np.std([1, 3], ddof=1) / 2)


def test_protocol_faults():
    p = protocol_from(PROTOCOL)
    assert faults(p) == []
    broken = json.loads(json.dumps(PROTOCOL))
    broken["clinical data"]["Grade"]["position"] = 9
    broken["clinical data"]["Sex"]["cardinality"] = 3
    broken["clinical data"]["Outcome"]["ground-truth"] = "no"
    assert len(faults(protocol_from(broken))) == 5  # truth, cardinality and the gaps 3, 7, 8
    assert id_column(["a", "Patient_Name"]) == "Patient_Name"


def test_imputation_rounds_by_the_kind_of_sentinel(spark):
    df = spark.createDataFrame([(1, 34.0), (2, -999.0), (3, 130.0), (4, 131.0)], "i int, v double")
    assert rows(prepare.impute_mean(df, ["v"], -999), "i")[1][1] == 98.0
    assert rows(prepare.impute_mean(df, ["v"], -999.0), "i")[1][1] == pytest.approx(295 / 3)
    with pytest.raises(SpecError):
        prepare.impute_mean(df, ["v"], "NA")
    halves = spark.createDataFrame([(2.5,), (2.4,), (-2.5,), (-2.4,)], "x double")
    assert [r[0] for r in halves.select(prepare.half_up(F.col("x"))).collect()] == [3.0, 2.0, -2.0, -2.0]


def test_expansion_counts(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "b", None), (4, None, None), (5, "b", "z"), (6, "a", "w")], "i int, p string, q string")
    out = rows(prepare.expand_categories(df, ["p", "q"]), "i", "p")
    assert out == [(1, "a", "x"), (2, "a", "y"), (2, "b", "y"), (5, "b", "z"), (6, "a", "w")]  # q has four levels: row 3 goes


def test_derived_days_and_encoding(clinical):
    df, _ = clinical
    p = protocol_from(PROTOCOL)
    assert [r.Days for r in prepare.derive(df, p).orderBy("Patient ID").collect()] == [10, 4, -999, -999]
    enc = prepare.encode(df.select("Patient ID", "Sex", "Grade"), list(p.variables))
    assert enc.columns == ["Patient ID", "Sex", "Grade"]
    hot = prepare.encode(df.select("Grade"), [Variable("Grade", cardinality=3, levels=("low", "mid", "high"), order=0)])
    assert hot.columns == ["Grade_high", "Grade_low", "Grade_mid"]


def test_merge_refuses_a_repeated_key(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="more than one row"):
        prepare.merge_many_to_one(left, right, "k").collect()
    assert rows(prepare.merge_many_to_one(left, right.limit(1), "k"), "k")[1] == (2, None)


def test_pseudonyms_repeat_and_existing_names_stay(spark):
    ids = spark.createDataFrame([("b", ""), ("a", "patient00009_ZZZZZ")], "k string, n string")
    once = rows(prepare.pseudonym_map(ids, "k", existing="n"), "k")
    assert once == rows(prepare.pseudonym_map(ids, "k", existing="n"), "k")
    assert once[0][1] == "patient00009_ZZZZZ" and once[1][1].startswith("patient00002_")


def test_upsert_gives_one_id_to_a_value_that_comes_twice(spark):
    existing = spark.createDataFrame([("a", 7)], "s string, id bigint")
    new = spark.createDataFrame([("c",), ("b",), ("c",), ("a",), (None,)], "s string")
    assert rows(etl.upsert(existing, new, "s", "id"), "s") == [("a", 7, False), ("b", 8, True), ("c", 9, True)]


def test_long_facts_do_not_carry_values_over(spark):
    wide = spark.createDataFrame([(1, 5.0, None), (2, None, "x"), (3, float("nan"), None)], "k int, a double, b string")
    out = rows(etl.long_facts(wide, ["k"], [etl.Fact(10, number="a"), etl.Fact(11, text="b")]), "k")
    assert [(r[0], r[1], r[2], r[3]) for r in out] == [(1, 10, 5.0, None), (2, 11, None, "x")]


def test_conditions(spark):
    labels = spark.createDataFrame([("disease_2",), ("x",), ("y",), ("x",)], "l string")
    concepts = spark.createDataFrame([("x", 205), ("old", 5)], "concept_name string, concept_id bigint")
    assert rows(etl.conditions(labels, "l", concepts), "label") == [("disease_2", 101), ("x", 205), ("y", 206)]
    assert rows(etl.conditions(labels, "l", concepts.where("concept_id < 200")), "label") == [("disease_2", 101), ("x", 200), ("y", 201)]


def test_ids_are_gapless_over_partitions(spark):
    out = etl.new_ids(spark.range(1000).repartition(7), ["id"], 50, "n")
    assert rows(out.select("id", "n"), "id") == [(i, 51 + i) for i in range(1000)]


def test_pooled_moments_equal_those_of_all_rows(spark):
    df = spark.createDataFrame([("a", float(i * i % 17)) for i in range(40)] + [("b", float(i % 5 + 100)) for i in range(9)], "s string, x double")
    got = moments.pooled_moments(moments.local_moments(df, "s", ["x"]), ["x"]).first()
    x = [r.x for r in df.collect()]
    assert (got.n_total, got.mean_x, got.sd_x) == (49, pytest.approx(np.mean(x)), pytest.approx(np.std(x)))


def test_covariance_by_pairs_and_by_vectors_agree(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([("ab"[i % 2], *map(float, r), [float(v) for v in r]) for i, r in enumerate(x)], "s string, a double, b double, c double, d double, v array<double>")
    one, two = covariance.pooled(covariance.local_scatter(df, "s", list("abcd"))), covariance.pooled(covariance.vector_scatter(df, "s", "v", 4))
    assert np.allclose(one.covariance, np.cov(x, rowvar=False)) and np.allclose(two.covariance, one.covariance)
    assert covariance.local_scatter(df, "s", list("abcd")).count() == 2  # a row a site leaves it, no more
    found = covariance.principal_components(one.correlation, 0.7)
    assert np.allclose(found.explained.sum(), 1) and found.explained[: found.kept].sum() >= 0.7
    raw = df.select(*covariance.score_columns(list("abcd"), one, found.loadings, standardise=False)).first()[0]
    assert raw == pytest.approx(float(x[0] @ found.loadings[:, 0]))


def test_t2_centres_unless_asked(spark):
    df = spark.createDataFrame([("s", 100.0 + i % 3) for i in range(30)] + [("s", 160.0)], "s string, p double")
    assert covariance.t2_outliers(df, "s", ["p"]).where("outlier").count() == 1
    assert covariance.t2_outliers(df, "s", ["p"], centre=False).where("outlier").count() == 31


def test_t2_rows_of_a_site_do_not_meet_in_one_task(spark, monkeypatch):
    df = spark.range(20_000).selectExpr("CASE WHEN id % 10 < 8 THEN 'large' WHEN id % 10 = 8 THEN 's' || id % 50 END AS s", "id", "sin(id) AS p").repartition(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        few = covariance.t2_outliers(df, "s", ["p"])
        want = rows(few, "id")
        assert "hashpartitioning(s#" not in few._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(covariance, "HOT_KEYS", 1)
        many = covariance.t2_outliers(df, "s", ["p"])
        assert rows(many, "id") == want and len(want) == 18_000 and many.columns == few.columns
        sizes = many.select(F.spark_partition_id().alias("at")).groupBy("at").count().toPandas()["count"]
        assert sizes.max() < 12_000  # and not the 16,000 of the large site
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_similarities(spark):
    boxes = similarity.bounding_boxes(spark.createDataFrame([("a", 0.0, 0.0), ("a", 2.0, 2.0), ("b", 1.0, 1.0), ("b", 3.0, 3.0), ("c", 9.0, 9.0), ("c", 10.0, 10.0)], "s string, x double, y double"), "s", ["x", "y"])
    got = {(r[0], r[1]): r[2] for r in similarity.overlap_similarity(boxes, "s").collect()}
    assert got["a", "a"] == 1 and got["a", "b"] == pytest.approx(0.25) and got["a", "c"] == 0 and len(got) == 9
    c = np.array([[2.0, 0.3], [0.3, 1.0]])
    assert similarity.frechet(np.zeros(2), c, np.zeros(2), c) == pytest.approx(0, abs=1e-9)
    assert similarity.frechet(np.zeros(1), np.eye(1), np.array([3.0]), 4 * np.eye(1)) == pytest.approx(10)


def test_learning(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 2))
    df = spark.createDataFrame([("ab"[i % 2], float(r[0]), float(r[1]), int(r[0] - r[1] > 0)) for i, r in enumerate(x)], "s string, a double, b double, y int").cache()
    model = learning.train_logistic(df, "s", ["a", "b"], "y", rounds=15, rate=6.0)
    scores = learning.evaluate_across(df, "s", ["a", "b"], "y", {"m": model, "z": learning.Linear((0.0, 0.0), -1.0)})
    assert scores.where("model = 'm'").agg(F.min("accuracy")).first()[0] > 0.95
    assert learning.best_model(scores).first().model == "m"
    assert scores.where("model = 'z'").first().precision == 0  # a ratio of nothing
    with pytest.raises(RuntimeError):
        learning.train_logistic(df, "s", ["a", "b"], "y", rounds=1, min_sites=3)


def test_replicate_groups_follow_chains(spark):
    v = [(i, [0.0005 * i, 1.0, 2.0]) for i in range(4)] + [(10, [5.0, 1.0, 2.0]), (11, [5.0, 1.0, 2.0]), (20, [9.0, 1.0, 2.0])]
    out = rows(replicates.replicate_groups(spark.createDataFrame(v, "k int, x array<double>"), "k", "x"), "k")
    assert out == [(0, 0, True), (1, 0, False), (2, 0, False), (3, 0, False), (10, 10, True), (11, 10, False)]


def test_replicates_of_keys_that_several_rows_have(spark):
    at = lambda v: [v, 1.0, 2.0]
    v = [(3, at(0.0)), (5, at(0.0)), (5, at(4.0)), (9, at(4.0005)), (9, at(7.0)), (6, at(7.0)), (7, at(7.0)), (8, at(9.0)), (8, at(9.0)), (8, at(9.0005)), (2, at(11.0)), (2, at(11.0)), (4, at(11.0)), (5, at(20.0))]
    df = spark.createDataFrame(v, "k int, x array<double>").repartition(3)
    assert rows(replicates.replicate_groups(df, "k", "x"), "k") == [(2, 2, True), (3, 3, True), (4, 2, False), (5, 3, False), (6, 3, False), (7, 3, False), (9, 3, False)]
    near = spark.createDataFrame([(1, at(0.0)), (1, at(0.0004)), (2, at(0.0002)), (2, at(8.0))], "k int, x array<double>")
    assert rows(replicates.close_pairs(near, "k", "x").select("a", "b", F.round("distance", 6))) == [(1, 2, 0.0002)] * 2


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(rows(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert all(got[i] == 0 for i in range(51)) and all(got[100 + i] == 100 for i in range(30)) and len(got) == 81
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_images(spark):
    s = spark.createDataFrame([("p", "s", 1, 2.0, 2, 2, [1.0, 2.0, 3.0, 4.0]), ("p", "s", 2, 1.0, 2, 2, [5.0, 5.0, 5.0, 5.0]), ("p", "s", 3, 3.0, 2, 2, [2.0, 4.0, 6.0, 9.0])], "patient_id string, series_id string, slice_idx int, z double, h int, w int, pixels array<double>")
    assert rows(images.slice_checks(s, 3, 2).select("code", "slice_idx"), "code", "slice_idx") == [("E3401", 2), ("E3501", 1), ("E3501", 2), ("E3501", 3)]
    ordered = images.order_slices(s, ["series_id"])
    assert rows(ordered.select("slice_idx", "place", "reordered"), "slice_idx") == [(1, 2, True), (2, 1, True), (3, 3, True)]
    assert [r.discarded for r in images.normalise(s, "MRI").orderBy("slice_idx").collect()] == [False, True, False]
    assert rows(images.projection(s, ["series_id"], "z"), "pixel")[3] == ("s", 3, 9.0)
    small = images.resize(s, 1, 1).orderBy("slice_idx").first().pixels
    assert small == [2.5]


def test_mask_scores_against_numpy(spark):
    rng = np.random.default_rng(3)
    t, p = rng.integers(0, 3, 200), rng.integers(0, 3, 200)
    got = {r.label: (r.dice, r.iou) for r in images.mask_scores(spark.createDataFrame([(int(a), int(b)) for a, b in zip(t, p)], "t int, p int"), "t", "p").collect()}
    for k in range(3):
        both = ((t == k) & (p == k)).sum()
        assert got[k] == (pytest.approx(2 * both / ((t == k).sum() + (p == k).sum())), pytest.approx(both / ((t == k) | (p == k)).sum()))


def test_schema(spark):
    t = schema.conform(spark.createDataFrame([(1, 8532, 1990)], "person_id int, gender_concept_id int, year_of_birth int"), "person")
    assert t.columns[0] == "person_id" and len(t.columns) == 13
    assert rows(schema.null_faults(t, "person"), "column") == [("ethnicity_concept_id", 1), ("race_concept_id", 1)]
    for name in schema.TABLES:
        assert schema.empty(spark, name).count() == 0


def test_readers_and_writers(spark, tmp_path, clinical):
    df, units = clinical
    assert files.unique_names(["x", " x", "y", "x"]) == ["x", "x.1", "y", "x.2"]
    lines = rows(sinks.two_header_lines(df, units), "part")
    assert lines[0][1].startswith("Patient ID;Age") and lines[1][1] == ";years;;;;;" and len(lines) == 6
    bad = tmp_path / "bad.csv"
    bad.write_text("a;b\n1;2\n3;4\n")
    with pytest.raises(files.SourceError):
        files.read_two_headers(spark, str(bad))
    comma = tmp_path / "c.csv"
    comma.write_text("a,b\n1,x\n")
    assert files.read_csv(spark, str(comma)).first().a == "1"
    sample = tmp_path / "s"
    sample.mkdir()
    (sample / "one.json").write_text('{"f": 1.5, "g": 2}')
    (sample / "two.json").write_text("broken")
    assert rows(files.read_samples(spark, str(sample)), "sample", "feature") == [("one", "f", 1.5), ("one", "g", 2.0), ("two", None, None)]
    assert sinks.new_version(df, str(tmp_path / "out"), "1").endswith("version=1")
    with pytest.raises(Exception, match="already exists"):
        sinks.new_version(df, str(tmp_path / "out"), "1")


def test_cohort(spark):
    t = spark.createDataFrame([(1, 2, "b", 5.0), (1, 1, "a", 4.0), (2, 3, "a", 6.0), (1, 9, "a", 7.0)], "p int, i int, c string, v double")
    assert [x.i for x in cohort.nested_series(t, "p", ["i", "c"], ["i"]).orderBy("p").first().series] == [1, 2, 9]
    assert rows(cohort.pivot_first(t, "p", "c", "v", "i", ["a", "b"]), "p") == [(1, 4.0, 5.0), (2, 6.0, None)]


def test_quorum(spark):
    replies = spark.createDataFrame([("a", "OK"), ("a", "OK"), ("b", "FAILED"), ("c", "OK")], "site string, status string")
    assert incremental.quorum(replies, "site", "status", 2).count() == 2
    with pytest.raises(Exception, match="fewer than 3"):
        incremental.quorum(replies, "site", "status", 3).collect()


def test_streaming_checks_and_windows(spark, tmp_path):
    src = tmp_path / "in"
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(3).write.parquet(str(src))
    batch = spark.read.parquet(str(src))
    stream = incremental.stream_table(spark, str(src), batch.schema)
    q = incremental.check_stream(stream, [quality.Check("E401", "value", F.col("value") < 50)], str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("n")).first()[0] == batch.where("value < 50").count()
    ran = incremental.run_phases(spark, str(tmp_path / "state"), [("one", lambda: spark.range(1)), ("two", lambda: spark.range(2))])
    assert ran == ["one", "two"] and incremental.run_phases(spark, str(tmp_path / "state"), [("one", lambda: spark.range(1))]) == []


DDL = """--HINT DISTRIBUTE_ON_KEY(person_id)
CREATE TABLE cdm.note ( -- a comment
  note_id BIGINT NOT NULL,
  person_id SERIAL,
  title VARCHAR(250) NULL,
  score NUMERIC(10,2),
  tags VARCHAR(20) ARRAY,
  counts INTEGER[],
  flag BIT,
  CONSTRAINT pk PRIMARY KEY (note_id)
);
--HINT DISTRIBUTE ON RANDOM
CREATE TABLE "loc" (id integer not null);
"""


def test_schemas_come_from_a_script():
    assert schema.parse_ddl(DDL) == {
        "note": "note_id bigint!, person_id int!, title string, score double, tags array<string>, counts array<int>, flag boolean",
        "loc": "id int!",
    }
    assert schema.distribution_keys(DDL) == {"note": "person_id", "loc": "random"}
    assert schema.relax("vocabulary", ["vocabulary_name"], "note string").startswith("vocabulary_id string!, vocabulary_name string,")


def test_patient_ids_are_made_up_only_where_allowed(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "a string, b int")
    out, made = quality.with_patient_id(df, ["b"])
    assert made and rows(out.select("Patient ID", "a"), "a") == [(1, "x"), (2, "y")]
    assert not quality.with_patient_id(df.withColumnRenamed("a", "patient_name"))[1]
    with pytest.raises(ValueError, match="E101"):
        quality.with_patient_id(df, images=True)


def test_ground_truth_checks(spark):
    df = spark.createDataFrame([("a", 1.0)] * 9 + [("b", 9.0)], "g string, v double")
    levels = Variable("g", cardinality=2, levels=("a", "b"), ground_truth=True, unbalance=("<30%",))
    assert rows(quality.ground_truth_checks(df, levels)) == [("W902", 1, True)]
    number = Variable("v", "float", variability=("<10%",), ground_truth=True)
    assert rows(quality.ground_truth_checks(df, number)) == [("W903", None, True)]


def test_prepared_outputs(clinical):
    df, _ = clinical
    out = prepare.prepared_outputs(df, protocol_from(PROTOCOL), "Patient ID")
    assert out["continuous"].columns == ["Patient ID", "Age"] and out["ground_truth"].columns == ["Patient ID", "Outcome"]


def test_names_repeat_for_a_seed(spark):
    persons = spark.createDataFrame([(1, 8532), (2, 8507), (3, None)], "person_id bigint, gender_concept_id int")
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    make = lambda: rows(etl.synthetic_names(persons, names("Ann", "Eva"), names("Bob"), names("Lee", "Roy", "Kim"), 4), "person_id")
    assert make() == make() and [r[2] for r in make()][1:] == ["Bob", "Bob"] and make()[0][2] in ("Ann", "Eva")


def test_mask_operators(spark):
    v = spark.createDataFrame([("p", 1, "liver"), ("p", 1, "Liver2"), ("p", 2, "liver"), ("p", 3, "x")], "k string, place int, name string")
    assert rows(images.unite_segments(v, ["k"], ["place"], "name", {"liver": 1, "Liver2": 1}), "place") == [("p", 1, 1), ("p", 2, 1)]
    s = spark.createDataFrame([("p", 0), ("p", 1), ("p", 2)], "k string, slice_idx int")
    assert rows(images.drop_slices(s, spark.createDataFrame([("p", 2)], "k string, discarded_slice int"), ["k"]), "slice_idx") == [("p", 0), ("p", 2)]
    assert images.knee([0, 0.1, 0.2, 0.3, 5]) == 3
    shapes = spark.createDataFrame([("p", 2, 2), ("p", 2, 3), ("q", 2, 2)], "k string, h int, w int")
    assert rows(images.shape_faults(shapes, ["k"])) == [("p", 2)]
    turned = images.to_lps(spark.createDataFrame([(2, 2, [1, 2, 3, 4], "ra")], "h int, w int, pixels array<int>, flips string")).first().pixels
    assert turned == [4, 3, 2, 1]


def test_one_vector_has_no_replicates(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "k int, x array<double>")
    assert replicates.close_pairs(one, "k", "x").count() == 0 and replicates.replicate_groups(one, "k", "x").count() == 0


def test_angles_count_below_the_threshold(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0])], "a array<double>, b array<double>")
    assert images.within_angle(df, "a", "b", 45).first().share == 0.5
    assert images.within_angle(df, "a", "b", 90.1).first().share == 1.0


def test_imbalance_counts_rows_without_a_level(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 3, "g string")
    got = {r.level: (r.n, round(r.gap, 6), r.flagged) for r in quality.imbalance(df, "g", 2, "<30%").collect()}
    assert got == {"a": (5, 0.0, False), "b": (2, 60.0, True)}


def test_results_merge_and_summary(spark):
    old = spark.createDataFrame([(4, "W401", "warning", "x", 1, True), (1, "E101", "error", None, 1, True)], quality.RESULT)
    new = spark.createDataFrame([(4, "W401", "warning", "x", 3, True), (7, "W701", "warning", None, 0, False)], quality.RESULT)
    both = quality.merge_results(old, new)
    assert quality.total_warnings(both).first().n_warnings == 3
    assert rows(quality.summarise(both, {"W401": "varies"}).select("code", "description", "n"), "code") == [("E101", None, None), ("W401", "varies", 3)]
    assert [r.line for r in sinks.report(both).collect()] == ["phase 1: error E101 (1)", "phase 4: warning W401 (3)"]
