"""DuckDB SQL with the same results as the named Spark queries.

Every statement is a chain of common table expressions ending in one SELECT.
Amounts are summed as DECIMAL(18,6), because sums of doubles depend on order.
"""

from __future__ import annotations

AS_OF = "DATE '2024-04-14'"
INDUSTRIES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
FACETS = "plan_type IN ('Growth','Enterprise') AND industry IN ('AUTOMOBILE','BUILDING','FURNITURE')"

_STEPS: dict[str, str] = {
    "accounts": f"""
        SELECT c_custkey AS account_idx,
               CASE WHEN c_custkey % 19 = 7 THEN NULL
                    ELSE concat('ACC-', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) END AS account_id,
               c_name AS company_name, c_mktsegment AS industry,
               CASE WHEN c_custkey % 10 < 6 THEN 'Starter'
                    WHEN c_custkey % 10 < 9 THEN 'Growth' ELSE 'Enterprise' END AS plan_type,
               n_name AS country,
               {AS_OF} - CAST(30 + c_custkey % 700 AS INT) AS contract_start_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "source_orders": "SELECT * FROM orders",
    "latest_orders": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey
                                         ORDER BY o_orderdate DESC, o_orderkey) AS rn
            FROM orders) z
        WHERE rn = 1""",
    "usage_events": """
        SELECT CASE WHEN event_id % 17 = 3 THEN NULL
                    ELSE concat('EVT-', lpad(CAST(event_id AS VARCHAR), 9, '0')) END AS event_id,
               concat('ACC-', lpad(CAST(user_id AS VARCHAR), 9, '0')) AS account_id,
               event_type AS feature_name, CAST(ts AS DATE) AS event_date,
               value AS session_duration_minutes,
               CAST(json_extract_string(props, '$.k') AS INT) AS pages_viewed
        FROM events""",
    "bronze_accounts": "SELECT * FROM accounts WHERE account_id IS NOT NULL",
    "bronze_subscriptions": "SELECT * FROM subscriptions WHERE subscription_id IS NOT NULL",
    "bronze_usage_events": "SELECT * FROM usage_events WHERE event_id IS NOT NULL",
    "usage_90d": f"""
        SELECT account_id, count(*) AS usage_event_count_90d,
               CAST(sum(CAST(session_duration_minutes AS DECIMAL(18,6))) AS DOUBLE)
                   AS total_session_minutes_90d,
               CAST(sum(pages_viewed) AS BIGINT) AS total_pages_viewed_90d
        FROM bronze_usage_events
        WHERE event_date >= {AS_OF} - 90
        GROUP BY account_id""",
    "silver_rows": """
        SELECT s.account_id, s.subscription_id, a.company_name, a.industry, a.plan_type,
               a.country, a.contract_start_date, s.monthly_recurring_revenue, s.status,
               s.renewal_date, s.status = 'churned' AS is_churned,
               coalesce(u.usage_event_count_90d, 0) AS usage_event_count_90d,
               coalesce(u.total_session_minutes_90d, 0.0::DOUBLE) AS total_session_minutes_90d,
               coalesce(u.total_pages_viewed_90d, 0) AS total_pages_viewed_90d
        FROM bronze_subscriptions s
        JOIN bronze_accounts a USING (account_id)
        LEFT JOIN usage_90d u USING (account_id)""",
    "heavy_subscriptions": """
        SELECT * REPLACE (CASE WHEN left(md5(subscription_id), 1) < '5' THEN 'ACC-000000001'
                               ELSE account_id END AS account_id)
        FROM bronze_subscriptions""",
    "silver": "SELECT * FROM silver_rows WHERE status IN ('active', 'churned', 'trial')",
    "gold": """
        SELECT plan_type, industry,
               CAST(sum(CASE WHEN status = 'active'
                             THEN CAST(monthly_recurring_revenue AS DECIMAL(18,6))
                             ELSE 0 END) AS DOUBLE) AS active_mrr,
               CAST(sum(CAST(monthly_recurring_revenue AS DECIMAL(18,6))) AS DOUBLE) AS total_mrr,
               count(DISTINCT account_id) AS account_count,
               count(*) FILTER (WHERE is_churned) AS churned_account_count
        FROM silver GROUP BY plan_type, industry""",
    "segments": """
        SELECT *, account_count - churned_account_count AS active_accounts,
               CAST(churned_account_count AS DOUBLE) / nullif(account_count, 0) AS churn_rate,
               CASE WHEN account_count > churned_account_count
                    THEN active_mrr / (account_count - churned_account_count)
               END AS avg_mrr_per_active
        FROM gold""",
    "faceted": f"SELECT * FROM segments WHERE {FACETS}",
    "features": f"""
        SELECT account_id, CAST(is_churned AS INT) AS is_churned,
               coalesce(plan_type, 'Unknown') AS plan_type,
               coalesce(industry, 'Unknown') AS industry,
               coalesce(country, 'Unknown') AS country,
               CAST({AS_OF} - contract_start_date AS INT) AS tenure_days,
               greatest(coalesce(monthly_recurring_revenue, 0.0::DOUBLE), 0.0::DOUBLE)
                   AS monthly_recurring_revenue,
               usage_event_count_90d AS total_events_90d,
               total_session_minutes_90d, total_pages_viewed_90d
        FROM (SELECT *, row_number() OVER (PARTITION BY account_id
                           ORDER BY renewal_date DESC NULLS LAST, subscription_id) AS rn
              FROM silver) z
        WHERE rn = 1""",
    "split": """
        SELECT account_id, is_churned,
               row_number() OVER (PARTITION BY is_churned ORDER BY md5(account_id))
                   <= round(0.2 * count(*) OVER (PARTITION BY is_churned)) AS is_test
        FROM features""",
    "fixed": """
        SELECT *, round_even(1.0::DOUBLE / (1.0::DOUBLE + exp(-(
                      1.6::DOUBLE - 0.004::DOUBLE * tenure_days
                      - 0.01::DOUBLE * total_events_90d
                      + CASE WHEN plan_type = 'Starter' THEN 0.5::DOUBLE
                             ELSE 0.0::DOUBLE END))), 4) AS churn_risk
        FROM features""",
    "risks": """
        SELECT account_id, plan_type, tenure_days, monthly_recurring_revenue, total_events_90d,
               total_session_minutes_90d, churn_risk,
               CASE WHEN churn_risk <= 0.4::DOUBLE THEN 'Low'
                    WHEN churn_risk <= 0.7::DOUBLE THEN 'Medium' ELSE 'High' END AS risk_band
        FROM fixed WHERE is_churned = 0""",
}

# The coefficients of the model that runs through the job's own stages.
_NUMBERS = {
    "tenure_days": -0.6,
    "monthly_recurring_revenue": 0.1,
    "total_events_90d": -0.8,
    "total_session_minutes_90d": -0.3,
    "total_pages_viewed_90d": 0.15,
}
_CATEGORIES = ("plan_type", "industry", "country")
_LOG_ODDS = (
    """0.2::DOUBLE
       + CASE plan_type WHEN 'Starter' THEN 0.5::DOUBLE WHEN 'Enterprise' THEN -0.75::DOUBLE
                        ELSE 0.0::DOUBLE END
       + CASE WHEN industry = 'BUILDING' THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END
       + CASE WHEN country = 'GERMANY' THEN -0.4::DOUBLE ELSE 0.0::DOUBLE END"""
    + "".join(f" + {w}::DOUBLE * ({c} - mean_{c}) / dev_{c}" for c, w in _NUMBERS.items())
)


def _copies() -> str:
    """Test rows with one feature after another taken from the donor row."""
    features = (*_CATEGORIES, *_NUMBERS)

    def copy(feature: str) -> str:
        taken = ", ".join(f"{'d' if c == feature else 'o'}.{c}" for c in features)
        return f"""
            SELECT '{feature}' AS feature, repeat, o.is_churned, {taken}
            FROM pairs JOIN test_rows o USING (account_id)
            JOIN test_rows d ON d.account_id = donor_key
            {"" if feature else "WHERE repeat = 0"}"""

    return " UNION ALL ".join(copy(f) for f in (*features, ""))


_STEPS |= {
    "train_rows": "SELECT f.* FROM features f JOIN split USING (account_id) WHERE NOT is_test",
    "test_rows": "SELECT f.* FROM features f JOIN split USING (account_id) WHERE is_test",
    "scale": "SELECT "
    + ", ".join(f"avg({c}) AS mean_{c}, stddev_samp({c}) AS dev_{c}" for c in _NUMBERS)
    + " FROM train_rows",
    "given_scores": f"""
        SELECT *, round_even(1.0::DOUBLE / (1.0::DOUBLE + exp(-({_LOG_ODDS}))), 4) AS churn_risk
        FROM features, scale""",
    "pairs": """
        SELECT r AS repeat, t.account_id, d.account_id AS donor_key
        FROM (SELECT account_id, row_number() OVER (ORDER BY md5(account_id)) AS pos
              FROM split WHERE is_test) t
        JOIN (SELECT account_id, r, row_number() OVER (
                         PARTITION BY r
                         ORDER BY md5('42:' || CAST(r AS VARCHAR) || ':' || account_id)) AS pos
              FROM split, (SELECT CAST(unnest(range(5)) AS INT) AS r) q
              WHERE is_test) d USING (pos)""",
    "copies": _copies(),
    "copy_scores": f"""
        SELECT feature, repeat, is_churned,
               1.0::DOUBLE / (1.0::DOUBLE + exp(-({_LOG_ODDS}))) AS score
        FROM copies, scale""",
}


def _subscriptions(orders: str) -> str:
    return f"""
        SELECT CASE WHEN o_orderkey % 19 = 11 THEN NULL
                    ELSE concat('SUB-', lpad(CAST(o_orderkey AS VARCHAR), 9, '0')) END
                   AS subscription_id,
               concat('ACC-', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS account_id,
               CASE WHEN o_orderkey % 13 = 5 THEN -o_totalprice ELSE o_totalprice END
                   AS monthly_recurring_revenue,
               CASE WHEN o_orderkey % 11 = 3 THEN 'paused' WHEN o_orderstatus = 'F' THEN 'churned'
                    WHEN o_orderstatus = 'O' THEN 'active' ELSE 'trial' END AS status,
               CAST(o_orderdate AS DATE) AS renewal_date
        FROM {orders}"""


def _chain(select: str, latest: bool = False) -> str:
    """All steps in order, then ``select``. DuckDB drops the unused ones."""
    steps: dict[str, str] = {}
    for name, body in _STEPS.items():
        steps[name] = body
        if name == "latest_orders":
            steps["subscriptions"] = _subscriptions("latest_orders" if latest else "source_orders")
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in steps.items()) + "\n" + select


def _rule_counts(table: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, '{action}' AS action, "
        f"count(*) FILTER (WHERE NOT coalesce({predicate}, FALSE)) AS violations, "
        f"count(*) AS total_rows FROM {source}"
        for name, predicate, action in rules
    )


_AUC = """
    SELECT {by} CAST(sum(pos * (2 * coalesce(below, 0) + neg)) AS DOUBLE)
                  / nullif(2.0::DOUBLE * sum(pos) * sum(neg), 0) AS auc,
           CAST(sum(pos) AS BIGINT) AS n_positive, CAST(sum(neg) AS BIGINT) AS n_negative
    FROM (SELECT *, sum(neg) OVER ({partition} ORDER BY score
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
          FROM (SELECT {by} {score} AS score, count(*) FILTER (WHERE is_churned = 1) AS pos,
                       count(*) FILTER (WHERE is_churned <> 1) AS neg
                FROM {source} GROUP BY ALL) c) w
    {group}"""


def _auc(source: str = "fixed", score: str = "churn_risk", by: str = "") -> str:
    return _AUC.format(
        by=f"{by}," if by else "",
        partition=f"PARTITION BY {by}" if by else "",
        group=f"GROUP BY {by}" if by else "",
        source=source,
        score=score,
    )


_KPIS = """
    SELECT *, coalesce(CAST(total_churned AS DOUBLE) / nullif(total_accounts, 0), 0)
                  AS overall_churn_rate,
           coalesce(total_active_mrr / nullif(total_active_accounts, 0), 0) AS avg_mrr_per_active
    FROM (SELECT coalesce(CAST(sum(CAST(active_mrr AS DECIMAL(18,6))) AS DOUBLE), 0)
                     AS total_active_mrr,
                 CAST(coalesce(sum(active_accounts), 0) AS BIGINT) AS total_active_accounts,
                 CAST(coalesce(sum(account_count), 0) AS BIGINT) AS total_accounts,
                 CAST(coalesce(sum(churned_account_count), 0) AS BIGINT) AS total_churned
          FROM {source}) t"""

_USD = "format('${{:,.0f}}', {0})"
_COUNT = "format('{{:,}}', {0})"
_PERCENT = "format('{{:.1f}}%', {0} * 100)"


def _matrix(source: str, industries: tuple[str, ...], texts: bool) -> str:
    def cell(industry: str) -> str:
        rate = f"avg(churn_rate) FILTER (WHERE industry = '{industry}')"
        return f"coalesce({_PERCENT.format(rate)}, '')" if texts else rate

    cells = ", ".join(f'{cell(i)} AS "{i}"' for i in industries)
    return f"SELECT plan_type, {cells} FROM {source} GROUP BY plan_type"


def _reports(source: str, industries: tuple[str, ...]) -> dict[str, str]:
    kpis = _KPIS.format(source=source)
    usd, count, percent = _USD.format, _COUNT.format, _PERCENT.format
    return {
        "kpis": kpis,
        "kpi_texts": f"""
            SELECT {usd('total_active_mrr')} AS total_active_mrr,
                   {count('total_active_accounts')} AS active_accounts,
                   {percent('overall_churn_rate')} AS overall_churn_rate,
                   {usd('avg_mrr_per_active')} AS avg_mrr_per_active
            FROM ({kpis}) k""",
        "mrr_by_industry": f"SELECT industry, plan_type, active_mrr FROM {source}",
        "mrr_share_by_plan": f"""
            SELECT plan_type, CAST(mrr AS DOUBLE) AS active_mrr,
                   CAST(mrr AS DOUBLE) / nullif(CAST(sum(mrr) OVER () AS DOUBLE), 0) AS mrr_share
            FROM (SELECT plan_type, sum(CAST(active_mrr AS DECIMAL(18,6))) AS mrr
                  FROM {source} GROUP BY plan_type) p""",
        "churn_matrix": _matrix(source, industries, texts=False),
        "churn_matrix_texts": _matrix(source, industries, texts=True),
        "mrr_vs_churn": f"""
            SELECT plan_type, industry, churn_rate, avg_mrr_per_active, account_count
            FROM {source}""",
        "segment_table": f"""
            SELECT plan_type AS "Plan", industry AS "Industry", active_mrr AS "Active MRR",
                   total_mrr AS "Total MRR", account_count AS "Accounts",
                   active_accounts AS "Active accounts",
                   churned_account_count AS "Churned accounts", churn_rate AS "Churn rate",
                   avg_mrr_per_active AS "Avg MRR / active"
            FROM {source}""",
        "segment_table_texts": f"""
            SELECT plan_type AS "Plan", industry AS "Industry",
                   {usd('active_mrr')} AS "Active MRR", {usd('total_mrr')} AS "Total MRR",
                   {count('account_count')} AS "Accounts",
                   {count('active_accounts')} AS "Active accounts",
                   {count('churned_account_count')} AS "Churned accounts",
                   {percent('churn_rate')} AS "Churn rate",
                   {usd('avg_mrr_per_active')} AS "Avg MRR / active"
            FROM {source}""",
    }


_FACETED_NAMES = {
    "mrr_share_by_plan": "mrr_share_faceted",
}


def _bucket(salt: str) -> str:
    digest = f"md5('{salt}:' || CAST(o_orderkey AS VARCHAR))"
    return f"('0x' || substr({digest}, 1, 8))::BIGINT % 100"


_ARRIVED = """
    SELECT source_key, company_name, plan_type, idx AS account_idx,
           'ACC-' || lpad(CAST(idx AS VARCHAR),
                          greatest(5, length(CAST(idx AS VARCHAR)))::INT, '0') AS account_id
    FROM (SELECT CAST(s_suppkey AS VARCHAR) AS source_key, s_name AS company_name,
                 CASE WHEN s_nationkey % 2 = 0 THEN 'Starter' ELSE 'Growth' END AS plan_type,
                 (SELECT coalesce(max(account_idx), -1) + 1 FROM accounts) - 1
                 + row_number() OVER (ORDER BY md5(CAST(s_suppkey AS VARCHAR))) AS idx
          FROM supplier) b"""


def oracle_sql() -> dict[str, str]:
    silver_rules = [
        ("account_id_present", "account_id IS NOT NULL", "FAIL"),
        ("valid_status", "status IN ('active', 'churned', 'trial')", "DROP"),
        ("non_negative_mrr", "monthly_recurring_revenue >= 0", "WARN"),
    ]
    gold_rules = [
        ("non_negative_active_mrr", "active_mrr >= 0", "WARN"),
        ("positive_account_count", "account_count > 0", "FAIL"),
    ]
    bronze_counts = " UNION ALL ".join(
        _rule_counts(f"bronze_{t}", t, [(name, f"{key} IS NOT NULL", "DROP")])
        for t, name, key in (
            ("accounts", "valid_account_id", "account_id"),
            ("subscriptions", "valid_subscription_id", "subscription_id"),
            ("usage_events", "valid_event_id", "event_id"),
        )
    )
    plain = {
        "bronze_accounts": "SELECT * FROM bronze_accounts",
        "bronze_subscriptions": "SELECT * FROM bronze_subscriptions",
        "bronze_usage_events": "SELECT * FROM bronze_usage_events",
        "bronze_stream_accounts": "SELECT * FROM bronze_accounts",
        "bronze_stream_subscriptions": "SELECT * FROM bronze_subscriptions",
        "bronze_stream_usage_events": "SELECT * FROM bronze_usage_events",
        "dq_bronze_counts": bronze_counts,
        "dq_silver_counts": _rule_counts("silver_account_health", "silver_rows", silver_rules),
        "dq_gold_counts": _rule_counts("gold_mrr_by_plan_industry", "gold", gold_rules),
        "usage_90d": "SELECT * FROM usage_90d",
        "usage_90d_from_daily": "SELECT * FROM usage_90d",
        "usage_90d_incremental": "SELECT * FROM usage_90d",
        "stream_ledger_counts": """
            SELECT 'total_rows' AS metric, count(*) AS row_count FROM usage_events
            UNION ALL
            SELECT 'valid_event_id', count(*) FROM usage_events WHERE event_id IS NULL""",
        "committed_freshness": """
            SELECT strftime(max(day + to_hours(urgent)), '%Y-%m-%d %H:%M:%S') AS refreshed_at
            FROM (SELECT CAST(o_orderdate AS DATE) AS day,
                         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent
                  FROM orders GROUP BY 1) z
            WHERE urgent > 0""",
        "silver_account_health": "SELECT * FROM silver",
        "silver_one_heavy_account": """
            SELECT s.account_id, s.subscription_id, a.company_name, a.industry, a.plan_type,
                   a.country, a.contract_start_date, s.monthly_recurring_revenue, s.status,
                   s.renewal_date, s.status = 'churned' AS is_churned,
                   coalesce(u.usage_event_count_90d, 0) AS usage_event_count_90d,
                   coalesce(u.total_session_minutes_90d, 0.0::DOUBLE) AS total_session_minutes_90d,
                   coalesce(u.total_pages_viewed_90d, 0) AS total_pages_viewed_90d
            FROM heavy_subscriptions s
            JOIN bronze_accounts a USING (account_id)
            LEFT JOIN usage_90d u USING (account_id)
            WHERE s.status IN ('active', 'churned', 'trial')""",
        "gold_mrr_by_plan_industry": "SELECT * FROM gold",
        "gold_snapshot": "SELECT * FROM gold",
        "published_silver": "SELECT * FROM silver",
        "failed_publish": "SELECT * FROM gold",
        "observed_counts": f"""
            SELECT table_name, constraint_name AS metric, violations AS row_count
            FROM ({_rule_counts("silver_account_health", "silver_rows", silver_rules)}) r
            UNION ALL
            SELECT 'silver_account_health', 'total_rows', count(*) FROM silver_rows""",
        "appended_twice": """
            SELECT plan_type, count(*) AS accounts, count(DISTINCT account_id) AS different
            FROM bronze_accounts GROUP BY plan_type""",
        "account_features": "SELECT * FROM features",
        "train_test_split": "SELECT * FROM split",
        "split_churn_rate": """
            SELECT is_test, count(*) AS row_count, avg(is_churned) AS churn_rate
            FROM split GROUP BY is_test""",
        "confusion_metrics": """
            SELECT *, CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0) AS accuracy,
                   coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
                   coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
                   coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1
            FROM (SELECT count(*) FILTER (WHERE is_churned = 1 AND churn_risk >= 0.5) AS tp,
                         count(*) FILTER (WHERE is_churned <> 1 AND churn_risk >= 0.5) AS fp,
                         count(*) FILTER (WHERE is_churned = 1 AND churn_risk < 0.5) AS fn,
                         count(*) FILTER (WHERE is_churned <> 1 AND churn_risk < 0.5) AS tn
                  FROM fixed) c""",
        "roc_auc": _auc(),
        "roc_auc_by_plan": _auc(by="plan_type"),
        "champion": f"""
            SELECT model, auc FROM (
                SELECT 0 AS position, 'logreg_baseline' AS model, auc FROM ({_auc()}) a
                UNION ALL
                SELECT 1, 'gradient_boosted_trees', auc
                FROM ({_auc(score='round_even(1.0::DOUBLE - churn_risk, 4)')}) b) m
            ORDER BY auc DESC, position LIMIT 1""",
        "encoded_features": " UNION ALL ".join(
            [
                f"SELECT account_id, '{c}=' || {c} AS feature, 1.0::DOUBLE AS value "
                f"FROM features WHERE {c} IN (SELECT {c} FROM train_rows)"
                for c in _CATEGORIES
            ]
            + [
                f"SELECT account_id, '{c}', "
                f"round(({c} - mean_{c}) / dev_{c}, 6) + 0.0::DOUBLE FROM features, scale"
                for c in _NUMBERS
            ]
        ),
        "scores_fixed_model": """
            SELECT account_id, plan_type, tenure_days, monthly_recurring_revenue,
                   total_events_90d, total_session_minutes_90d, churn_risk,
                   CASE WHEN churn_risk <= 0.4::DOUBLE THEN 'Low'
                        WHEN churn_risk <= 0.7::DOUBLE THEN 'Medium' ELSE 'High' END AS risk_band
            FROM given_scores WHERE is_churned = 0""",
        "importance_fixed": f"""
            SELECT feature, round_even(base - own, 4) AS importance
            FROM (SELECT feature, avg(auc) AS own,
                         max(CASE WHEN feature = '' THEN avg(auc) END) OVER () AS base
                  FROM ({_auc("copy_scores", "score", "feature, repeat")}) a
                  GROUP BY feature) m
            WHERE feature <> ''""",
        "shuffled_pairs": """
            SELECT r AS repeat, t.account_id, d.account_id AS donor_key
            FROM (SELECT account_id, row_number() OVER (ORDER BY md5(account_id)) AS pos
                  FROM split WHERE is_test) t
            JOIN (SELECT account_id, r, row_number() OVER (
                             PARTITION BY r
                             ORDER BY md5('42:' || CAST(r AS VARCHAR) || ':' || account_id)) AS pos
                  FROM split, (SELECT CAST(unnest(range(5)) AS INT) AS r) q
                  WHERE is_test) d USING (pos)""",
        "risk_scores_fixed": "SELECT * FROM risks",
        "risk_band_counts": """
            SELECT risk_band, count(*) AS account_count,
                   CAST(sum(CAST(monthly_recurring_revenue AS DECIMAL(18,6))) AS DOUBLE) AS mrr
            FROM risks GROUP BY risk_band""",
        "revenue_at_risk": """
            SELECT count(*) AS high_risk_accounts,
                   coalesce(CAST(sum(CAST(monthly_recurring_revenue AS DECIMAL(18,6))) AS DOUBLE), 0)
                       AS mrr_at_risk
            FROM risks WHERE risk_band = 'High'""",
        "top10_risk": "SELECT * FROM risks ORDER BY churn_risk DESC, account_id LIMIT 10",
        "arrival_keys": _ARRIVED,
        "arrival_subscriptions": f"""
            SELECT 'SUB-' || lpad(CAST(account_idx AS VARCHAR),
                                  greatest(5, length(CAST(account_idx AS VARCHAR)))::INT, '0')
                       AS subscription_id,
                   account_id, plan_type
            FROM ({_ARRIVED}) n""",
        "arrival_event_keys": """
            SELECT source_key, event_date,
                   'EVT-' || lpad(CAST(idx AS VARCHAR),
                                  greatest(8, length(CAST(idx AS VARCHAR)))::INT, '0') AS event_id
            FROM (SELECT CAST(o_orderkey AS VARCHAR) AS source_key,
                         CAST(o_orderdate AS DATE) AS event_date,
                         (SELECT coalesce(max(CAST(substr(event_id, 5) AS BIGINT)), -1)
                          FROM usage_events WHERE event_id IS NOT NULL)
                         + row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS idx
                  FROM orders) b""",
        "injected_violations": f"""
            SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
                   CASE WHEN {_bucket('subscription_id/5')} < 5 THEN NULL
                        ELSE 'SUB-' || CAST(o_orderkey AS VARCHAR) END AS subscription_id,
                   CASE WHEN {_bucket('status/10')} < 10 THEN 'paused' ELSE o_orderstatus END
                       AS status,
                   CASE WHEN {_bucket('monthly_recurring_revenue/8')} < 8 THEN -o_totalprice
                        ELSE o_totalprice END AS monthly_recurring_revenue
            FROM orders""",
    }
    checks = {name: _chain(select) for name, select in plain.items()}
    checks["segment_derived"] = _chain("SELECT * FROM segments", latest=True)
    checks["churn_alert"] = _chain(
        f"""SELECT overall_churn_rate AS churn_rate, 0.35::DOUBLE AS threshold,
                   overall_churn_rate > 0.35::DOUBLE AS fired
            FROM ({_KPIS.format(source='segments')}) k""",
        latest=True,
    )
    checks["segment_derived_published"] = _chain("SELECT * FROM segments")
    checks["churn_alert_published"] = _chain(
        f"""SELECT overall_churn_rate AS churn_rate, 0.35::DOUBLE AS threshold,
                   overall_churn_rate > 0.35::DOUBLE AS fired
            FROM ({_KPIS.format(source='segments')}) k"""
    )
    for name, select in _reports("segments", INDUSTRIES).items():
        checks[name] = _chain(select, latest=True)
        checks[f"{name}_published"] = _chain(select)
    for name, select in _reports("faceted", INDUSTRIES[:3]).items():
        checks[_FACETED_NAMES.get(name, f"{name}_faceted")] = _chain(select, latest=True)
    return checks
