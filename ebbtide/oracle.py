"""DuckDB SQL that computes every registered query independently.

Used as the correctness oracle: it reads the driver's generated tables
(``customer``, ``events``, ``nation`` views), maps them to the four inputs
with the same expressions as ``sources.fixtures``, and evaluates the
segmentation literally -- comma joins, the subscription fan-out, the
``NOT IN`` subquery and a second scan of orders joined back per customer --
so it checks the one-pass/semi-join rewrites of the Spark plans rather than
repeating them.
"""

from __future__ import annotations

from .config import (BACKFILL, FIXTURE_AS_OF, FIXTURE_AS_OF_MIDNIGHT, FIXTURE_AS_OF_MONTH_END, FIXTURE_NO_ORDERS,
                     SegmentConfig)
from .sources import fixtures as fx


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return ", ".join(_q(v) for v in values)


def mapping_ctes() -> str:
    """customers, orders, subscription_base, metros from the generated tables."""
    c = "c_custkey"
    return f"""
customers AS (
  SELECT {c} AS id,
         CAST(DATE {_q(fx.SIGNUP_BASE)} + CAST(({c} * 37) % 450 AS INTEGER) AS TIMESTAMP) AS created_at,
         CASE WHEN {c} % 23 = 1 THEN TIMESTAMP {_q(fx.CUSTOMER_DELETED)} END AS deleted_at,
         CASE WHEN {c} % 29 = 5 THEN 'tok_' || CAST({c} AS VARCHAR)
              WHEN {c} % 31 = 6 THEN NULL
              WHEN {c} % 37 = 7 THEN 'cusX' || CAST({c} AS VARCHAR)
              ELSE 'cus_' || CAST({c} AS VARCHAR) END AS stripe_customer_id,
         CASE WHEN {c} % 50 = 10 THEN 'Business Customer'
              WHEN {c} % 50 = 11 THEN 'ActionLink Vendor'
              WHEN {c} % 50 = 14 THEN NULL
              ELSE c_name END AS name,
         CASE WHEN {c} % 20 = 2 THEN 'BUSINESS'
              WHEN {c} % 20 = 3 THEN NULL
              ELSE 'consumer' END AS customer_type,
         CAST(CASE WHEN {c} % 19 = 4 THEN NULL
                   WHEN {c} % 11 = 7 THEN {c} % 5 + {fx.UNKNOWN_METRO}
                   ELSE c_nationkey END AS BIGINT) AS metro_id,
         CAST({c} % 104 AS INTEGER) AS bucket_number
  FROM customer
),
orders AS (
  SELECT event_id AS id,
         user_id * 2 + event_id % 2 AS customer_id,
         TIMESTAMP {_q(fx.ORDER_EPOCH)} + to_microseconds({fx.TIME_STRETCH} *
             (epoch_us(ts) - epoch_us(TIMESTAMP {_q(fx.EVENT_EPOCH)}))) AS created_at,
         CASE WHEN event_id % 41 = 0 THEN NULL ELSE ts END AS delivered_at,
         CASE WHEN ((user_id * 2 + event_id % 2) % 3 = 0 AND event_type IN ('purchase', 'click'))
                OR ((user_id * 2 + event_id % 2) % 3 = 1 AND event_type <> 'error')
                OR (user_id * 2 + event_id % 2) % 3 = 2
              THEN 'delivered' ELSE 'cancelled' END AS status,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(value AS DECIMAL(18,2)) END AS actual_subtotal
  FROM events
),
subscription_base AS (
  SELECT {c} AS customer_id,
         CASE WHEN {c} % 13 = 8 THEN 'gift' WHEN {c} % 5 = 1 THEN 'whitelabel'
              ELSE 'platform' END AS origination,
         CASE WHEN {c} % 17 = 3 THEN TIMESTAMP {_q(fx.SUBSCRIPTION_EVENT)} END AS deleted_at,
         CASE WHEN {c} % 43 = 9 THEN TIMESTAMP {_q(fx.SUBSCRIPTION_EVENT)} END AS trial_abandon_time,
         CASE WHEN {c} % 47 = 12 THEN TIMESTAMP {_q(fx.SUBSCRIPTION_EVENT)} END AS churn_payment_time
  FROM customer
  UNION ALL
  SELECT {c}, 'marketplace', CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP)
  FROM customer WHERE {c} % 3 = 0
),
metros AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name
  FROM nation
)"""


class Sql:
    """SQL fragments of one configuration (one ``as_of``)."""

    def __init__(self, cfg: SegmentConfig):
        self.cfg = cfg
        self.now = f"TIMESTAMP {_q(cfg.as_of)}"

    # --- predicates -------------------------------------------------------
    def signup(self, a="c"):
        cfg = self.cfg
        return (f"CAST({a}.created_at AS DATE) BETWEEN DATE {_q(cfg.signup_from)} "
                f"AND DATE {_q(cfg.signup_to)}")

    def not_deleted(self, a="c"):
        return f"{a}.deleted_at IS NULL"

    def payment(self, a="c"):
        return f"{a}.stripe_customer_id LIKE {_q(self.cfg.payment_pattern)}"

    def not_excluded(self, a="c"):
        cfg = self.cfg
        ors = " OR ".join(
            [f"LOWER(x.name) = {_q(n)}" for n in cfg.excluded_names]
            + [f"LOWER(x.customer_type) = {_q(t)}" for t in cfg.excluded_types]
        )
        return f"{a}.id NOT IN (SELECT DISTINCT x.id FROM customers x WHERE {ors})"

    def customer_preds(self, a="c"):
        return " AND ".join([self.signup(a), self.not_deleted(a), self.payment(a),
                             self.not_excluded(a)])

    def active_sub(self, a="sb"):
        return (f"{a}.origination IN ({_in(self.cfg.origins)}) AND {a}.deleted_at IS NULL "
                f"AND {a}.trial_abandon_time IS NULL AND {a}.churn_payment_time IS NULL")

    def delivered(self, a="o"):
        return f"{a}.status = {_q(self.cfg.delivered_status)} AND {a}.delivered_at IS NOT NULL"

    def months_back(self, m):
        return f"({self.now} - INTERVAL {m} MONTH)"

    def days_back(self, d):
        return self.now if d == 0 else f"({self.now} - INTERVAL {d} DAY)"

    def day_of(self, a="o"):
        return f"CAST(CAST({a}.created_at AS DATE) AS TIMESTAMP)"

    def in_recency(self, a="o"):
        older, newer = self.cfg.recency_months
        return f"{self.day_of(a)} BETWEEN {self.months_back(older)} AND {self.months_back(newer)}"

    def window(self, k):
        d = self.cfg.window_days
        return self.days_back(d * (k + 1)), self.days_back(d * k)

    def names(self, suffix):
        return [f"{n}{suffix}" for n in self.cfg.window_names]

    # --- stages -----------------------------------------------------------
    def lifetime(self):
        """Per eligible customer, joined with every active subscription row."""
        return f"""lifetime AS (
  SELECT c.id AS cid,
         MIN(o.created_at) AS first_order_date,
         MAX(o.created_at) AS last_order_date,
         COUNT(DISTINCT o.id) AS total_orders_lifetime,
         SUM(CASE WHEN {self.in_recency()} THEN 1 ELSE 0 END) AS recency
  FROM customers c, orders o, subscription_base sb
  WHERE {self.customer_preds()} AND {self.delivered()}
    AND c.id = o.customer_id AND c.id = sb.customer_id AND {self.active_sub()}
  GROUP BY c.id
)"""

    def regular_pred(self, a="l"):
        cfg = self.cfg
        return (f"{a}.total_orders_lifetime >= {cfg.min_orders} AND {a}.recency >= {cfg.min_recent} "
                f"AND {a}.first_order_date < {self.months_back(cfg.tenure_months)}")

    def windows(self, with_value=False):
        """Second scan of orders, joined back to the regular customers."""
        cols = []
        for k, name in enumerate(self.cfg.window_names):
            lo, hi = self.window(k)
            blank = f"{lo} < l.first_order_date"
            inside = f"{self.day_of()} BETWEEN {lo} AND {hi}"
            cols.append(f"SUM(CASE WHEN {blank} THEN NULL WHEN {inside} THEN 1 ELSE 0 END) AS c_{k}")
            if with_value:
                val = f"CASE WHEN {inside} THEN o.actual_subtotal END"
                cols.append(f"CASE WHEN {blank} THEN NULL ELSE CAST(SUM({val}) AS DOUBLE) / "
                            f"COUNT({val}) END AS {name}_monthly_AOV")
                cols.append(f"CASE WHEN {blank} THEN NULL ELSE CAST(SUM({val}) AS DECIMAL(38,2)) "
                            f"END AS {name}_monthly_GMV")
        body = ",\n         ".join(cols)
        casts = ", ".join(f"CAST(c_{k} AS BIGINT) AS {n}"
                          for k, n in enumerate(self.names("_order_count")))
        return f"""win_raw AS (
  SELECT l.cid, l.total_orders_lifetime, l.first_order_date, l.last_order_date,
         {body}
  FROM lifetime l, orders o
  WHERE o.customer_id = l.cid AND {self.delivered()} AND {self.regular_pred()}
  GROUP BY l.cid, l.total_orders_lifetime, l.first_order_date, l.last_order_date
),
win AS (
  SELECT * EXCLUDE ({", ".join(f"c_{k}" for k in range(self.cfg.n_windows))}), {casts}
  FROM win_raw
)"""

    @staticmethod
    def _mean_present(cols, as_double=False):
        num = " + ".join(f"COALESCE({c}, 0)" for c in cols)
        if as_double:
            num = f"CAST({num} AS DOUBLE)"
        den = " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in cols)
        return f"({num}) / NULLIF({den}, 0)"

    def scores(self, with_value=False):
        cfg = self.cfg
        counts = self.names("_order_count")
        lo, mid, hi = cfg.cohort_edges
        casual, core, power = cfg.cohort_names
        change = " + ".join(f"COALESCE(ABS({a} - {b}), 0)" for a, b in zip(counts, counts[1:]))
        extra = ""
        if with_value:
            gmv = self.names("_monthly_GMV")[1:]
            aov = self.names("_monthly_AOV")[1:]
            extra = (f",\n         {self._mean_present(gmv, True)} AS monthly_GMV_average"
                     f",\n         {self._mean_present(aov)} AS monthly_AOV_average")
        return f"""avg1 AS (
  SELECT *, {self._mean_present(counts[1:])} AS monthly_order_count_average{extra}
  FROM win
),
scored AS (
  SELECT *,
         CASE WHEN monthly_order_count_average >= {lo} AND monthly_order_count_average < {mid} THEN {_q(casual)}
              WHEN monthly_order_count_average >= {mid} AND monthly_order_count_average < {hi} THEN {_q(core)}
              ELSE {_q(power)} END AS cohort,
         ({change}) / NULLIF(monthly_order_count_average, 0) AS magnitude_index,
         CAST(date_diff('day', last_order_date, {self.now}) AS INTEGER) AS days_since_last_transaction,
         {cfg.window_days} / NULLIF(monthly_order_count_average, 0) AS avg_days_between_orders,
         monthly_order_count_average - {counts[0]} AS {cfg.window_names[0]}_drop_from_avg
  FROM avg1
)"""

    def label(self):
        cfg = self.cfg
        _, mid, hi = cfg.cohort_edges
        a = "monthly_order_count_average"
        bands = [f"{a} < {mid}", f"{a} >= {mid} AND {a} < {hi}", f"{a} >= {hi}"]
        d, g, m = "days_since_last_transaction", "avg_days_between_orders", "magnitude_index"
        arms = []
        for band, f, lab in zip(bands, cfg.stopper_factors, cfg.stopper_labels):
            arms.append(f"WHEN {band} AND {d} >= {g} * {f} THEN {_q(lab)}")
        for band, f, cut, labs in zip(bands, cfg.stopper_factors, cfg.magnitude_cuts,
                                      cfg.decreaser_labels):
            if cut is None:
                arms.append(f"WHEN {band} AND {d} < {g} * {f} THEN {_q(labs[0])}")
            else:
                arms.append(f"WHEN {band} AND {m} <= {cut} AND {d} < {g} * {f} THEN {_q(labs[0])}")
                arms.append(f"WHEN {band} AND {m} > {cut} AND {d} < {g} * {f} THEN {_q(labs[1])}")
        return "CASE " + " ".join(arms) + f" ELSE {_q(cfg.other_label)} END"

    def declining_pred(self):
        cfg = self.cfg
        return (f"monthly_order_count_average >= {cfg.min_average} AND "
                f"monthly_order_count_average * {cfg.drop_ratio} > {cfg.window_names[0]}_order_count")

    def arm(self, col):
        arms = " ".join(f"WHEN {col} BETWEEN {a.lo} AND {a.hi} THEN {_q(a.label)}"
                        for a in self.cfg.arms)
        return f"CASE {arms} END"

    def run_date(self):
        return f"CAST({self.now} AS DATE)"

    def pipeline(self, with_value=False):
        return ",\n".join([mapping_ctes(), self.lifetime(), self.windows(with_value),
                           self.scores(with_value)])


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def queries(cfg: SegmentConfig | None = None) -> dict[str, str]:
    s = Sql(cfg or SegmentConfig(as_of=FIXTURE_AS_OF))
    m = mapping_ctes()
    c = s.cfg
    counts = s.names("_order_count")
    out: dict[str, str] = {}
    # sources
    out["src_customers"] = _with(m) + "SELECT * FROM customers"
    out["src_orders"] = _with(m) + "SELECT * FROM orders"
    out["src_subscriptions"] = _with(m) + "SELECT * FROM subscription_base"
    out["src_metros"] = _with(m) + "SELECT * FROM metros"
    # filters
    out["elig_signup_range"] = _with(m) + f"SELECT c.id FROM customers c WHERE {s.signup()}"
    out["elig_not_deleted"] = _with(m) + f"SELECT c.id FROM customers c WHERE {s.not_deleted()}"
    out["elig_payment_like"] = _with(m) + f"SELECT c.id FROM customers c WHERE {s.payment()}"
    out["elig_not_excluded"] = _with(m) + f"SELECT c.id FROM customers c WHERE {s.not_excluded()}"
    out["elig_active_subscription"] = _with(m) + (
        f"SELECT DISTINCT sb.customer_id AS cid FROM subscription_base sb WHERE {s.active_sub()}")
    out["elig_delivered"] = _with(m) + (
        f"SELECT o.id, o.customer_id, o.created_at, o.actual_subtotal FROM orders o WHERE {s.delivered()}")
    out["eligible_customers"] = _with(m) + (
        f"SELECT DISTINCT c.id AS cid FROM customers c, subscription_base sb "
        f"WHERE {s.customer_preds()} AND c.id = sb.customer_id AND {s.active_sub()}")
    # joins
    out["join_active_subscription"] = _with(m) + (
        f"SELECT DISTINCT c.id AS cid FROM customers c, subscription_base sb "
        f"WHERE c.id = sb.customer_id AND {s.active_sub()}")
    out["join_customer_orders"] = _with(m) + (
        f"SELECT c.id AS cid, o.id AS order_id, o.created_at FROM customers c, orders o "
        f"WHERE c.id = o.customer_id AND {s.customer_preds()} AND {s.delivered()} AND c.id IN "
        f"(SELECT sb.customer_id FROM subscription_base sb WHERE {s.active_sub()})")
    # aggregates
    out["order_lifetime"] = _with(m, s.lifetime()) + (
        "SELECT cid, first_order_date, last_order_date, total_orders_lifetime FROM lifetime")
    out["recency_count"] = _with(m) + (
        f"SELECT c.id AS cid, CAST(SUM(CASE WHEN {s.in_recency()} THEN 1 ELSE 0 END) AS BIGINT) AS recency "
        f"FROM customers c, orders o WHERE c.id = o.customer_id AND {s.customer_preds()} AND "
        f"{s.delivered()} AND c.id IN (SELECT sb.customer_id FROM subscription_base sb "
        f"WHERE {s.active_sub()}) GROUP BY c.id")
    out["regular_customers"] = _with(m, s.lifetime()) + (
        "SELECT cid, first_order_date, last_order_date, total_orders_lifetime FROM lifetime l "
        f"WHERE {s.regular_pred()}")
    out["windowed_counts"] = _with(m, s.lifetime(), s.windows()) + (
        "SELECT cid, total_orders_lifetime, first_order_date, last_order_date, "
        + ", ".join(counts) + " FROM win")
    out["windowed_aov"] = _with(m, s.lifetime(), s.windows(True)) + (
        "SELECT cid, " + ", ".join(s.names("_monthly_AOV")) + " FROM win")
    out["windowed_gmv"] = _with(m, s.lifetime(), s.windows(True)) + (
        "SELECT cid, " + ", ".join(s.names("_monthly_GMV")) + " FROM win")
    # scores (every regular customer, before the decline filter)
    base = "WITH " + s.pipeline() + "\n"
    valued = "WITH " + s.pipeline(True) + "\n"
    out["monthly_average"] = base + "SELECT cid, monthly_order_count_average FROM scored"
    out["cohort_label"] = base + "SELECT cid, cohort FROM scored"
    out["magnitude_index"] = base + "SELECT cid, magnitude_index FROM scored"
    out["days_since_last"] = base + "SELECT cid, days_since_last_transaction FROM scored"
    out["days_between"] = base + "SELECT cid, avg_days_between_orders FROM scored"
    out["drop_from_avg"] = base + f"SELECT cid, {c.window_names[0]}_drop_from_avg FROM scored"
    out["gmv_average"] = valued + "SELECT cid, monthly_GMV_average FROM scored"
    out["aov_average"] = valued + "SELECT cid, monthly_AOV_average FROM scored"
    out["sub_group_label"] = base + f"SELECT cid, {s.label()} AS sub_group FROM scored"
    out["declining_filter"] = base + (
        f"SELECT cid, monthly_order_count_average, {counts[0]} FROM scored WHERE {s.declining_pred()}")
    out["test_arm"] = _with(m) + f"SELECT c.id, {s.arm('c.bucket_number')} AS test_cohort FROM customers c"
    # lists
    out.update(list_queries(s))
    return out


def list_queries(s: Sql, suffix: str = "") -> dict[str, str]:
    base = "WITH " + s.pipeline() + "\n"
    valued = "WITH " + s.pipeline(True) + "\n"
    lab = s.label()
    dec = s.declining_pred()
    cfg = s.cfg
    detail_cols = (
        ["cid", "first_order_date", "last_order_date", "monthly_order_count_average", "cohort",
         "magnitude_index", "days_since_last_transaction", "avg_days_between_orders",
         f"{cfg.window_names[0]}_drop_from_avg"]
        + s.names("_order_count") + ["monthly_GMV_average", "monthly_AOV_average"]
        + s.names("_monthly_AOV")
    )
    return {
        f"list_base{suffix}": base + (
            f"SELECT {s.run_date()} AS date, cid AS customer_id, {lab} AS sub_group "
            f"FROM scored WHERE {dec}"),
        f"list_metro{suffix}": base + (
            f"SELECT {s.run_date()} AS date, t.cid AS customer_id, m.name AS metro, {lab} AS sub_group "
            f"FROM scored t, customers c, metros m WHERE {dec} AND t.cid = c.id AND c.metro_id = m.id"),
        f"list_test{suffix}": base + (
            f"SELECT {s.run_date()} AS date, t.cid AS customer_id, {lab} AS sub_group, "
            f"{s.arm('c.bucket_number')} AS test_cohort "
            f"FROM scored t, customers c WHERE {dec} AND t.cid = c.id"),
        f"list_details{suffix}": valued + (
            f"SELECT {s.run_date()} AS run_date, {', '.join(detail_cols)}, {lab} AS sub_group "
            f"FROM scored WHERE {dec}"),
    }


def zero_average() -> str:
    """Scores of customers without any order in the windows: the average is 0."""
    s = Sql(SegmentConfig(as_of=FIXTURE_NO_ORDERS, min_recent=0))
    return "WITH " + s.pipeline() + (
        "\nSELECT cid, monthly_order_count_average, magnitude_index, avg_days_between_orders, "
        f"days_since_last_transaction, {s.label()} AS sub_group FROM scored")


def all_queries() -> dict[str, str]:
    out = queries()
    out.update(list_queries(Sql(SegmentConfig(as_of=FIXTURE_AS_OF_MIDNIGHT)), "_midnight"))
    out.update(list_queries(Sql(SegmentConfig(as_of=FIXTURE_AS_OF_MONTH_END)), "_month_end"))
    out["scores_zero_average"] = zero_average()
    # Execution variants of the same lists: same answer, different plans.
    for name in ("base", "metro", "test", "details"):
        out[f"all_lists_{name}"] = out[f"list_{name}"]
    for name in ("shuffled", "all_orders", "reduced"):
        out[f"list_base_{name}"] = out["list_base"]
    out["list_base_reduced_midnight"] = out["list_base_midnight"]
    out["list_details_salted"] = out["list_details"]
    for name in ("list_base", "list_base_midnight", "list_details", "order_lifetime"):
        out[f"{name}_incremental"] = out[name]
    out["elig_not_in"] = out["elig_not_excluded"]
    out["list_base_checked"] = out["list_base"]
    out["list_details_exact"] = out["list_details"]
    out["list_base_bucketed"] = out["list_base_bucketed_join"] = out["list_base"]
    out["list_details_bucketed_hot"] = out["list_details"]
    out["list_base_backfill"] = "\nUNION ALL\n".join(
        f"SELECT * FROM ({list_queries(Sql(SegmentConfig(as_of=t)))['list_base']})" for t in BACKFILL)
    return out
