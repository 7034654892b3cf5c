"""Steps that several queries share stay off the rows of the large tables."""

import datetime as dt

from pyspark.sql import functions as F

from covercast import catalog
from covercast.operators import capacity, evaluate, slots
from covercast.plans import importance, model, training, upcoming
from covercast.shared import stored_over_cores
from covercast.sources import benchmark

AS_OF = dt.date(2001, 1, 1)


def tables(spark):
    """Tables of two templates, on several rows each."""
    part = spark.createDataFrame([(100 + t, 1 + t % 7) for t in (*range(30), *range(30))], "p_partkey bigint, p_size int")
    return benchmark.template_tables(part)


def lines(df, *words):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if all(w in line for w in words)]


def test_slots_are_not_listed_to_filter_the_rows_before_them(spark):
    settings = capacity.shift_setting_capacity(tables(spark), capacity.SLOT_COLUMNS)
    sittings = settings.withColumns({"shift_date": F.lit(AS_OF), "util_capacity": F.lit(10.0)})
    found = slots.slot_capacity(sittings)
    assert not lines(found, "Filter", "from_json")
    assert found.count() > 0 and found.filter("slot_index is null").count() == 0


def test_pacing_is_evaluated_per_setting_and_not_per_kind_of_table(spark):
    found = capacity.shift_setting_capacity(tables(spark))
    evaluated = lines(found, "AS max_shift_capacity")
    assert evaluated and not any("table_size" in line for line in evaluated)
    one = found.groupBy("venue_key_id", "int_id", "max_shift_capacity").count()
    assert one.filter("count > 1").count() == 0


def test_documents_of_a_small_file_are_built_on_all_cores(spark):
    part = spark.range(2000).selectExpr("id as p_partkey", "cast(id % 50 as int) as p_size").coalesce(1)
    assert benchmark.template_tables(part).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_importances_score_the_variants_once(spark, monkeypatch):
    """What comes back is a small table: the base AUC is no second pass over all variants."""
    made = spark.createDataFrame([(None, 0.9), ("a", 0.5), ("b", 0.9)], "variant string, auc_score double")
    passes = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda v: (passes.add(1), v)[1], "string").asNondeterministic()
    monkeypatch.setattr(importance, "shuffled", lambda df, *_: df)
    monkeypatch.setattr(importance.models, "score", lambda model, df: df)
    monkeypatch.setattr(evaluate, "metrics_by", lambda judged, by: made.withColumn("variant", seen("variant")))
    found = importance.shuffled_importances(None, made, ["a", "b"], ["variant"])
    assert sorted((r.feature, round(r.importance, 6)) for r in found.collect()) == [("a", 0.4), ("b", 0.0)]
    assert passes.value == 3


def slot_tables(spark, folder):
    """Ten venues with templates, overrides and reservations, some of which come twice."""
    number = "cast({} as int)".format
    spark.range(1000).selectExpr("id as p_partkey", f"{number('id % 50')} as p_size", "'kind ' || id % 3 as p_type").write.parquet(f"{folder}/part.parquet")
    spark.range(50).selectExpr("id as s_suppkey", "'name ' || id as s_name").write.parquet(f"{folder}/supplier.parquet")
    spark.range(6000).selectExpr(
        "id % 5500 as l_orderkey", "id * 7 % 1000 as l_partkey", "id * 3 % 50 as l_suppkey", f"{number('id % 7')} as l_linenumber",
        "cast(id % 50 as double) as l_quantity", "element_at(array('R', 'A', 'N'), " + number("id % 3") + " + 1) as l_returnflag",
        "timestamp_ntz'1995-01-02 00:00:00' + make_dt_interval(" + number("id % 500") + ") as l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_kept_sittings_and_settings_give_the_same_slots(spark, tmp_path):
    src = benchmark.sources(spark, slot_tables(spark, tmp_path))
    settings = capacity.all_setting_capacity(src, capacity.SLOT_COLUMNS)
    for plan in (training.training_slot, upcoming.upcoming_slot):
        plain = plan(src, benchmark.AS_OF, benchmark.NOW)
        kept = plan(src, benchmark.AS_OF, benchmark.NOW, keep=stored_over_cores, settings=settings)
        assert plain.columns == kept.columns
        wanted = sorted(map(repr, plain.collect()))
        assert wanted and sorted(map(repr, kept.collect())) == wanted


def test_scores_evaluate_the_settings_once_and_hold_no_copy_of_the_rows(spark, monkeypatch, tmp_path):
    folder = slot_tables(spark, tmp_path)
    evaluated, held = [], []
    build, fit = capacity.shift_setting_capacity, model.PipelineModel
    cached = lambda: spark._jsparkSession.sharedState().cacheManager().isEmpty()
    monkeypatch.setattr(capacity, "shift_setting_capacity", lambda *a, **k: (evaluated.append(1), build(*a, **k))[1])
    monkeypatch.setattr(model, "PipelineModel", lambda stages: (held.append(not cached()), fit(stages))[1])
    monkeypatch.setattr(catalog, "SHORT", model.BoostParams(trees=2, step=0.3, patience=1))
    spark.catalog.clearCache()
    scores = catalog.queries()["model_scores"](spark, folder)
    assert held == [False] and len(evaluated) == 1
    assert scores.count() == upcoming.upcoming_slot(benchmark.sources(spark, folder), benchmark.AS_OF, benchmark.NOW).count() > 0


def test_few_stored_rows_stay_in_place_and_many_are_dealt_out(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = (stored_over_cores(spark.range(n).coalesce(1), "numbers") for n in (500, 20_000))
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == cores
    assert (few.count(), many.count(), many.distinct().count()) == (500, 20_000, 20_000)
