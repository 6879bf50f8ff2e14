import pytest

from demesne.plans import integrity, register, terms
from oracle import compare

CASES = {**integrity.REGISTRY.oracles, **register.REGISTRY.oracles, **terms.REGISTRY.oracles}
QUERIES = {**integrity.REGISTRY.queries, **register.REGISTRY.queries, **terms.REGISTRY.queries}


@pytest.mark.parametrize("name", sorted(CASES))
def test_query_equals_sql(spark, sf, name):
    compare(spark, sf, QUERIES[name], CASES[name])


def test_every_query_has_sql_or_a_check_of_its_own():
    assert set(QUERIES) - set(CASES) == {"p4_profile", "term_model_residue", "join_district_region"}


def test_profile_holds_the_base_aggregates_and_bounded_aucs(spark, sf):
    p = QUERIES["p4_profile"](spark, sf)
    base = QUERIES["p4_base_aggregates"](spark, sf)
    assert sorted(map(tuple, p.select(base.columns).collect()), key=str) == sorted(map(tuple, base.collect()), key=str)
    assert all(0 <= r[c] <= 1 for r in p.collect() for c in ("auc_full", "auc_without", "auc_alone"))


def test_model_gets_what_the_rules_leave(spark, sf):
    left = QUERIES["term_parsed"](spark, sf).filter("pattern IS NULL").select("_id").join(spark.read.parquet(f"{sf}/leases.parquet").filter("trim(term) <> ''").select("_id", "term"), "_id").distinct()
    got = QUERIES["term_model_residue"](spark, sf)
    assert {r[0] for r in got.select("_id").collect()} == {r["_id"] for r in left.collect()} != set()
    assert got.filter("valid AND (start IS NULL OR expiry IS NULL)").count() == 0


def test_regions_by_brute_force(spark, sf):
    from demesne.operators import regions
    from demesne.operators.spatial import rings_of

    strips = {"west": (-7.5, -4.4), "middle": (-4.2, -2.1), "east": (-1.9, 1.5)}
    shapes = {r["lad_code"]: rings_of(r["geometry"]) for r in spark.read.parquet(f"{sf}/districts.parquet").collect()}
    for r in QUERIES["join_district_region"](spark, sf).collect():
        x, y = regions.representative_point(shapes[r["code"]])
        cx, _ = regions.centroid(shapes[r["code"]])
        holds = lambda v, y=y: next((k for k, (a, b) in strips.items() if a < v < b and 49.5 < y < 60.5), None)
        want = holds(x) or holds(cx) or min(strips, key=lambda k: max(strips[k][0] - x, x - strips[k][1]))
        assert r["region"] == want


def test_entry_point_lists_every_query_once():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(CASES) <= set(e.oracle_sql())
