import pytest

from renewlens import schemas
from renewlens.plans import reports

GOLD = [
    ("Growth", "Retail", 100.0, 150.0, 4, 1),
    ("Starter", "Retail", 50.0, 60.0, 2, 2),
    ("Enterprise", "Fintech", 850.0, 900.0, 2, 0),
    ("Starter", "Fintech", 0.0, 0.0, 2, 1),
]


@pytest.fixture
def segments(spark):
    return reports.segment_metrics(spark.createDataFrame(GOLD, schemas.GOLD))


def test_derived_columns(segments):
    rows = {(r.plan_type, r.industry): r for r in segments.collect()}
    growth, starter = rows["Growth", "Retail"], rows["Starter", "Retail"]
    assert (growth.active_accounts, growth.churn_rate) == (3, 0.25)
    assert growth.avg_mrr_per_active == pytest.approx(100 / 3)
    assert (starter.active_accounts, starter.avg_mrr_per_active) == (0, None)


def test_kpis_are_ratios_of_sums(segments):
    k = reports.kpis(segments).first()
    assert (k.total_active_mrr, k.total_active_accounts) == (1000.0, 6)
    assert k.overall_churn_rate == pytest.approx(0.4)
    assert k.avg_mrr_per_active == pytest.approx(1000 / 6)
    t = reports.kpi_texts(segments).first()
    assert tuple(t) == ("$1,000", "6", "40.0%", "$167")


def test_empty_selection_is_legal(segments):
    empty = reports.facets(segments, plans=[])
    assert empty.count() == 0
    k = reports.kpis(empty).first()
    assert tuple(k) == (0.0, 0, 0, 0, 0.0, 0.0)
    assert reports.mrr_share_by_plan(empty).count() == 0


def test_facets_are_combined(segments):
    got = reports.facets(segments, ["Starter", "Growth"], ["Retail"]).collect()
    assert {(r.plan_type, r.industry) for r in got} == {("Starter", "Retail"), ("Growth", "Retail")}


def test_default_facet_keeps_known_plans_else_all(spark):
    mixed = spark.createDataFrame(GOLD + [("Legacy", "Retail", 1.0, 1.0, 1, 0)], schemas.GOLD)
    assert {r.plan_type for r in reports.facets(mixed).collect()} == set(schemas.PLAN_ORDER)
    foreign = mixed.filter("plan_type = 'Legacy'")
    assert reports.facets(foreign).count() == 1


def test_orders(segments):
    by_industry = [(r.industry, r.plan_type) for r in reports.mrr_by_industry(segments).collect()]
    assert by_industry == [
        ("Fintech", "Starter"), ("Fintech", "Enterprise"), ("Retail", "Starter"),
        ("Retail", "Growth"),
    ]
    table = [(r["Plan"], r["Industry"]) for r in reports.segment_table(segments).collect()]
    assert table == sorted(table)
    matrix = reports.churn_matrix(segments, ["Fintech", "Retail"])
    assert [r.plan_type for r in matrix.collect()] == ["Starter", "Growth", "Enterprise"]


def test_matrix_keeps_empty_columns(segments):
    matrix = {r.plan_type: r for r in reports.churn_matrix(segments, ["Retail", "Energy"]).collect()}
    assert matrix["Growth"].Retail == 0.25
    assert matrix["Growth"].Energy is None
    texts = {
        r.plan_type: r for r in reports.churn_matrix_texts(segments, ["Retail", "Energy"]).collect()
    }
    assert (texts["Growth"].Retail, texts["Growth"].Energy) == ("25.0%", "")


def test_shares_add_up(segments):
    shares = {r.plan_type: r.mrr_share for r in reports.mrr_share_by_plan(segments).collect()}
    assert shares == {"Starter": 0.05, "Growth": 0.1, "Enterprise": 0.85}


def test_texts(segments):
    row = reports.segment_table_texts(segments).filter("Plan = 'Enterprise'").first()
    assert row["Active MRR"] == "$850"
    assert row["Churn rate"] == "0.0%"
    assert row["Avg MRR / active"] == "$425"


@pytest.mark.parametrize("threshold, fired", [(0.35, True), (0.4, False), (0.41, False)])
def test_alert_is_strict(segments, threshold, fired):
    row = reports.churn_alert(segments, threshold).first()
    assert (row.threshold, row.fired) == (threshold, fired)
