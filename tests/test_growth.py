"""Steps whose rows are many more than the bytes they are read from."""

from __future__ import annotations

from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks import registry
from taxaloom.operators import fuzzy, order, pairs, ranking, results, search
from taxaloom.operators.attach import VERNACULARS
from taxaloom.operators.order import placed
from taxaloom.plans import verify
from taxaloom.session import cut
from taxaloom.sources import writers


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("distance", [1, 2])
def test_traces_of_stems_are_not_sent_to_all_tasks(spark, distance):
    stems = cut(spark.createDataFrame([("bubo bubo",), ("aquila alba",)], "stem string"))
    records = cut(spark.createDataFrame([("bubo bubb",), ("aquila albo",)], "matched_stem string"))
    traces = fuzzy.spread_stems(records, "matched_stem", distance)
    met = fuzzy.stem_neighbours(stems, traces, distance, guard_short_words=False)
    assert "SortMergeJoin [trace" in _plan(met)
    assert {tuple(r) for r in met.collect()} == {("bubo bubo", "bubo bubb", 1), ("aquila alba", "aquila albo", 1)}


def test_places_need_no_shuffle_by_range(spark):
    numbered = placed(spark.range(500).selectExpr("id", "cast(id % 7 AS string) AS word"), [F.asc("word"), F.desc("id")])
    joins = [line for line in _plan(numbered).splitlines() if "Join [_range" in line]
    assert len(joins) == 1 and "BroadcastHashJoin" in joins[0] and "BuildRight" in joins[0]
    rows = sorted((r["place"], r["word"], r["id"]) for r in numbered.collect())
    assert [r[0] for r in rows] == list(range(500))
    assert [r[1:] for r in rows] == sorted(((r[1], r[2]) for r in rows), key=lambda r: (r[0], -r[1]))


def test_first_places_of_profiles_are_not_sent_to_all_tasks(spark):
    rows = spark.range(60).selectExpr(
        "cast(id % 5 AS string) AS profile", "cast(id % 3 AS double) AS sort_score", "cast(id AS string) AS matched_name",
        "1 AS data_source_id", "cast(id AS string) AS record_id",
    )
    ranked = ranking.rank_results(rows)
    found, rows = {}, ranked.collect()
    final = _plan(ranked).split("Initial Plan")[0]
    assert "SortMergeJoin [profile" in final and "BroadcastHashJoin [profile" not in final
    for r in rows:
        found.setdefault(r["profile"], []).append((r["rn"], -r["sort_score"], r["matched_name"]))
    for places in found.values():
        assert [p[0] for p in sorted(places)] == list(range(1, 13))
        assert [p[1:] for p in sorted(places)] == sorted(p[1:] for p in places)


def _matches(spark):
    """Matches of five profiles with columns that ranking needs and others."""
    return spark.range(60).selectExpr(
        "cast(id % 5 AS string) AS profile", "cast(id % 3 AS double) AS sort_score", "cast(id AS string) AS matched_name",
        "1 AS data_source_id", "cast(id AS string) AS record_id", "'k' AS match_key", "0.5 AS rank_score",
        "0.5 AS curation_score", "'Linnaeus' AS matched_authors_text", "'a|b' AS classification_path",
    )


def _stored(monkeypatch):
    """The columns of what is stored for ranking, as it is stored."""
    stored, keep = [], order.cut
    monkeypatch.setattr(order, "cut", lambda rows: stored.append(rows.columns) or keep(rows))
    return stored


def _places_hold(ranked):
    rows = sorted((r["profile"], -r["sort_score"], r["matched_name"], r["rn"]) for r in ranked.collect())
    assert [r[-1] for r in rows] == [*range(1, 13)] * 5


def test_query_of_ranks_stores_only_what_it_shows_or_orders(spark, monkeypatch):
    stored, found = _stored(monkeypatch), _matches(spark)
    tables = SimpleNamespace(verification=lambda sources: SimpleNamespace(all_matches=lambda: found))
    ranked = registry.rank_results(tables)
    assert stored and all(not {"match_key", "rank_score", "classification_path"} & set(columns) for columns in stored)
    _places_hold(ranked.join(found.select("profile", "record_id", "sort_score", "matched_name"), ["profile", "record_id"]))


def test_flat_rows_rank_without_what_scores_are_made_of(spark, monkeypatch):
    stored, found = _stored(monkeypatch), _matches(spark)
    run = verify.Verification(*[None] * 6, sources=[0], every=True)
    monkeypatch.setattr(verify.Verification, "all_matches", lambda self: found)
    ranked = run._ranked()
    assert stored and all("classification_path" in columns and not set(results.ONLY_FOR_SCORES) & set(columns) for columns in stored)
    _places_hold(ranked)


def test_fan_out_is_the_join(spark, monkeypatch):
    monkeypatch.setattr(pairs, "SIDE", 3)
    left = [(k, n) for k, many in (("a", 11), ("b", 1), (None, 9), ("left", 8)) for n in range(many)] + [("a", 0)] * 4
    right = [(k, str(n)) for k, many in (("a", 7), ("b", 10), (None, 5), ("right", 8)) for n in range(many)] + [("b", None)] * 2
    met = pairs.fan_out(
        cut(spark.createDataFrame(left, "k string, n int")), cut(spark.createDataFrame(right, "k string, t string")), "k"
    )
    assert met.columns == ["k", "n", "t"]
    assert Counter(map(tuple, met.collect())) == Counter((k, n, t) for k, n in left for j, t in right if k is not None and k == j)


def test_fan_out_sends_rows_by_the_number_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "SIDE", 10)
    left, right = (cut(spark.range(2000).selectExpr("'a' AS k", f"id AS {name}")) for name in ("n", "t"))
    sent, deal = [], type(left).repartition
    monkeypatch.setattr(type(left), "repartition", lambda self, *by: sent.append(self) or deal(self, *by))
    met = pairs.fan_out(left, right, "k")
    assert met.count() == met.distinct().count() == 4_000_000
    assert len(sent) == 2 and sum(rows.count() for rows in sent) <= 200_000


def _tasks(df) -> list[int]:
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]


def _facets(rows, **values):
    given = {c: F.lit(values.get(c)).cast("int" if c.startswith("year") else "string") for c in search.FACETS}
    return cut(rows.select(F.col("id").alias("query_id"), *[given[c].alias(c) for c in given]))


def test_searches_of_one_year_are_shared_by_tasks(spark):
    facets = _facets(spark.range(3000), year_from=1800)
    records = cut(spark.range(3000).selectExpr("1 AS data_source_id", "cast(id AS string) AS record_id", "1850 AS year"))
    tasks = _tasks(search.facet_year(facets, records))
    assert sum(tasks) == 9_000_000 and max(tasks) <= 4_500_000


def test_searches_of_one_word_are_shared_by_tasks(spark):
    facets = _facets(spark.range(3000), any_epithet="alba")
    records = cut(spark.range(3000).selectExpr("1 AS data_source_id", "cast(id AS string) AS record_id", "array('alba') AS epithets"))
    tasks = _tasks(search.facet_any_epithet(facets, records))
    assert sum(tasks) == 9_000_000 and max(tasks) <= 4_500_000


def test_other_genders_are_distinct_without_comparing_what_is_found(spark):
    facets = cut(
        _facets(spark.range(1), species="alba", any_epithet="alba")
        .unionByName(_facets(spark.range(1, 2), species="alba"))
        .unionByName(_facets(spark.range(2, 3), infraspecies="alba"))
        .unionByName(_facets(spark.range(2, 3), infraspecies="alba"))
        .unionByName(_facets(spark.range(3, 4), any_epithet="alb."))
    )
    records = [(1, "a", ["albus"]), (1, "b", ["major", "albus"]), (1, "c", ["albus", "albus"]), (1, "c", ["albus"]), (1, "d", ["alba"])]
    records = cut(spark.createDataFrame(records, "data_source_id int, record_id string, epithets array<string>"))
    found = search.facet_gender(facets, records)
    assert found._jdf.queryExecution().optimizedPlan().nodeName() != "Aggregate"
    assert sorted((r["query_id"], r["facet"], r["word"], r["record_id"]) for r in found.collect()) == sorted(
        (q, "alba", "albus", r) for q, rs in ((0, "abc"), (1, "ac"), (2, "bc")) for r in rs
    )


def test_compressed_sinks_hold_the_same(spark, tmp_path):
    numbers = [*results.SCORE_FIELDS, "sort_score"]
    fields = {c: F.lit(0.5 if c in numbers else "some words").alias(c) for c in [*results.RESULT_FIELDS, *results.SCORE_FIELDS]}
    fields["vernaculars"] = F.lit(None).cast(VERNACULARS).alias("vernaculars")
    best = spark.range(1).select(F.lit("p").alias("profile"), F.lit("k").alias("match_key"), *fields.values())
    names = spark.createDataFrame([(n, f"Aus {n}", "p") for n in range(400)], "row_id long, name string, profile string")
    documents = results.with_errors(results.nest_results(names, best), names.limit(0).withColumn("error", F.lit("")))
    for kind in (None, "gzip"):
        writers.write_json_docs(documents, f"{tmp_path}/{kind}", compression=kind)
        writers.write_delimited(results.flat_rows(documents), f"{tmp_path}/flat-{kind}", compression=kind)
    assert Counter(spark.read.text(f"{tmp_path}/None").collect()) == Counter(spark.read.text(f"{tmp_path}/gzip").collect())
    plain, packed = (spark.read.csv(f"{tmp_path}/flat-{kind}", header=True) for kind in (None, "gzip"))
    assert Counter(plain.collect()) == Counter(packed.collect()) and plain.count() == 400
    size = {kind: sum(f.stat().st_size for f in (tmp_path / str(kind)).glob("part-*")) for kind in (None, "gzip")}
    assert size["gzip"] * 4 < size[None]
