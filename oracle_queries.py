"""DuckDB SQL for the registered queries, over the same Parquet tables."""

from __future__ import annotations

V = [f"v{i}" for i in range(1, 29)]
# Planted class signal per vector position.
SIGNAL = {4: "0.08", 11: "0.08", 12: "-0.12", 14: "-0.15", 17: "-0.18"}
NEW_FEATURES = [
    "hour_of_day", "high_risk_hour", "amount_zscore", "high_value_flag", "v1_v3_interact", "v4_v11_interact",
]
FEATURES = [*V, "amount_scaled", *NEW_FEATURES]
INTEGER_FEATURES = ("hour_of_day", "high_risk_hour", "high_value_flag")
THRESHOLDS = (50, 100, 200, 500, 1000, 2000, 5000)


def r(x: str, d: int) -> str:
    return f"cast(round(cast({x} as decimal(28,10)), {d}) as double)"


def pct(num: str, den: str, d: int) -> str:
    return r(f"cast({num} as double) * 100.0::double / nullif(cast({den} as double), 0)", d)


def hash32(tag: str, *keys: str) -> str:
    text = f"'{tag}'" + "".join(f" || ':' || {k}" for k in keys)
    return f"cast('0x' || substr(md5({text}), 1, 8) as bigint)"


_EVENTS = """
b as (select min(ts) as t0 from events),
ne as (select count(*) as n from embeddings),
e as (select event_id as id,
             (epoch_us(ts) - epoch_us(b.t0)) / 1000000.0::double as time_seconds,
             round(value * 10, 2) as amount,
             cast(case when event_type = 'error' and event_id % 7 in (0, 1) then 1 else 0 end as integer) as class,
             event_id % ne.n as vec_id
      from events, b, ne),
"""
_VECTORS = ",\n".join(
    f"cast(m.embedding[{i}] as double) + e.class * ({SIGNAL.get(i, '0.0')}::double) as v{i}" for i in range(1, 29)
)
_TABLE = f"""
t0 as (select e.id, e.time_seconds, {_VECTORS}, e.amount, e.class
       from e left join embeddings m on m.vec_id = e.vec_id),
"""
_DERIVED = """
st as (select avg(amount) as mu, stddev_pop(amount) as sd, quantile_cont(amount, 0.99) as p99 from t0),
t as (select t0.*,
             cast(((floor(time_seconds / 3600)::bigint % 24) + 24) % 24 as integer) as hour_of_day,
             case when st.sd = 0 then 0.0 else (amount - st.mu) / st.sd end as amount_scaled,
             case when st.sd = 0 then 0.0 else (amount - st.mu) / st.sd end as amount_zscore,
             cast(case when amount > st.p99 then 1 else 0 end as integer) as high_value_flag,
             v1 * v3 as v1_v3_interact, v4 * v11 as v4_v11_interact
      from t0, st),
f as (select *, cast(case when hour_of_day >= 23 or hour_of_day <= 4 then 1 else 0 end as integer) as high_risk_hour
      from t)
"""
BASE = f"with {_EVENTS}{_TABLE}{_DERIVED}"

_DIRTY = f"""
d as (select time_seconds, {', '.join(V)}, case when id % 97 = 0 then null else amount end as amount, class
      from (select * from t0 union all select * from t0 where id % 10 = 0))
"""
DIRTY = f"with {_EVENTS}{_TABLE}{_DIRTY}"
_ORDER = ", ".join(f"{c} nulls first" for c in ["time_seconds", *V, "amount", "class"])
_NUMBERED = f"un as (select *, row_number() over (order by {_ORDER}) - 1 as id from u)"


# The chain: repeated raw rows, cleaned and numbered, then the features of the scaled amount.
_RAW = f"""
d as (select time_seconds, {', '.join(V)}, amount, class from (select * from t0 union all select * from t0 where id % 10 = 0)),
u as (select distinct * from d),
{_NUMBERED},
us as (select avg(amount) as mu, stddev_pop(amount) as sd from u),
cl as (select un.* exclude (amount), (amount - mu) / sd as amount_scaled from un, us),
st as (select quantile_cont(amount_scaled, 0.99) as p99 from cl),
t as (select cl.*, cast(((floor(time_seconds / 3600)::bigint % 24) + 24) % 24 as integer) as hour_of_day,
             amount_scaled as amount_zscore, cast(case when amount_scaled > p99 then 1 else 0 end as integer) as high_value_flag,
             v1 * v3 as v1_v3_interact, v4 * v11 as v4_v11_interact from cl, st),
f as (select *, cast(case when hour_of_day >= 23 or hour_of_day <= 4 then 1 else 0 end as integer) as high_risk_hour
      from t)
"""
CHAIN = f"with {_EVENTS}{_TABLE}{_RAW}"


def scored_cte(name: str, lift: int) -> str:
    p = f"((id * 37) % 101 + {lift} * class) / {101 + lift}.0::double"
    return f"""{name} as (select id, class as label, {p} as prob,
        cast(case when {p} > 0.5 then 1 else 0 end as integer) as prediction from t0)"""


SCORED = f"{BASE}, {scored_cte('s', 30)}"
MODELS = f"""{BASE}, {scored_cte('sa', 15)}, {scored_cte('sb', 30)},
s as (select 'Base' as model, 1 as position, * from sa union all select 'Tuned' as model, 2 as position, * from sb)"""

# Cells and metrics; ``by`` is '' or 'model, position'.
_CELLS = """
    cast(count(*) filter (where label = 0 and prediction = 0) as bigint) as tn,
    cast(count(*) filter (where label = 0 and prediction = 1) as bigint) as fp,
    cast(count(*) filter (where label = 1 and prediction = 0) as bigint) as fn,
    cast(count(*) filter (where label = 1 and prediction = 1) as bigint) as tp"""


def prf(tp: str, fp: str, fn: str) -> tuple[str, str, str]:
    def z(num: str, den: str) -> str:
        return f"coalesce(cast({num} as double) / nullif(cast({den} as double), 0), 0.0)"

    return z(tp, f"({tp} + {fp})"), z(tp, f"({tp} + {fn})"), z(f"2 * {tp}", f"(2 * {tp} + {fp} + {fn})")


P, R, F1 = prf("tp", "fp", "fn")
CM = f"{SCORED}, cm as (select {_CELLS} from s)"


def curve(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    part = f"partition by {by} " if by else ""
    return f"""
g as (select {lead}prob, cast(sum(label) as double) as p, cast(sum(1 - label) as double) as f from s group by {lead}prob),
c as (select *, sum(p) over ({part}order by prob desc) as cp, sum(f) over ({part}order by prob desc) as cf,
             sum(p) over ({part}) as ap, sum(f) over ({part}) as af from g)"""


AUC = "sum(f * (cp - p / 2)) / nullif(max(ap) * max(af), 0)"
AP = "sum(p * cp / (cp + cf)) / nullif(max(ap), 0)"
METRICS = f"""{MODELS}, {curve('model, position')},
hard as (select model, position, {_CELLS} from s group by model, position),
areas as (select model, {AUC} as roc_auc from c group by model),
mm as (select hard.model as name, position, roc_auc, {R} as recall, {P} as precision, {F1} as f1
       from hard join areas on areas.model = hard.model)"""

SPLIT = f"""{BASE},
seats as (select cast(ceil(round(0.2 * count(*), 9)) as bigint) as k, count(*) as n from f),
want as (select class, k * count(*)::double / n as exact, k from f, seats group by class, k, n),
part as (select class, cast(floor(exact) as bigint)
             + case when row_number() over (order by exact - floor(exact) desc, cast(class as varchar))
                    <= k - sum(cast(floor(exact) as bigint)) over () then 1 else 0 end as quota from want),
hashed as (select f.*, row_number() over (partition by class order by {hash32('42', 'id')}, id) as place from f),
sp as (select hashed.*, case when place <= quota then 'test' else 'train' end as split
       from hashed join part on part.class = hashed.class)"""

_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATURES)
KNN = f"""{SPLIT},
mi as (select * from sp where split = 'train' and class = 1),
pairs as (select a.id as id, b.id as neighbour_id, {_D2} as d2 from mi a join mi b on a.id <> b.id),
nn as (select id, cast(row_number() over (partition by id order by d2, neighbour_id) as integer) as rank,
              neighbour_id, sqrt(d2) as distance from pairs qualify rank <= 5)"""


def _step(c: str) -> str:
    value = f"a.{c} + u * (b.{c} - a.{c})"
    return f"cast(trunc({value}) as integer) as {c}" if c in INTEGER_FEATURES else f"{r(value, 6)} as {c}"


SMOTE = f"""{KNN},
need as (select count(*) filter (where class = 0) - count(*) filter (where class = 1) as missing,
                count(*) filter (where class = 1) as n from sp where split = 'train'),
bases as (select mi.*, missing // n + case when row_number() over (order by {hash32('42:base', 'mi.id')}, mi.id)
                 <= missing % n then 1 else 0 end as take from mi, need),
grown as (select bases.*, unnest(range(1, cast(take as bigint) + 1)) as copy_no from bases),
drawn as (select *, {hash32('42:neighbour', 'id', 'copy_no')} % 5 + 1 as pick,
                 {hash32('42:step', 'id', 'copy_no')} / 4294967296.0::double as u from grown),
syn as (select a.id, a.copy_no, a.class, {', '.join(_step(c) for c in FEATURES)}
        from drawn a join nn on nn.id = a.id and nn.rank = a.pick join mi b on b.id = nn.neighbour_id)"""

TESTED = f"{SPLIT}, ts as (select count(*) as n, cast(sum(class) as bigint) as frauds from sp where split = 'test')"

LABEL = "case class when 1 then 'Fraud' else 'Legitimate' end"
LATE = "(hour_of_day = 23 or hour_of_day between 0 and 4)"
BETWEEN = "(hour_of_day between 5 and 8 or hour_of_day between 20 and 22)"


def band(middle: str) -> str:
    return f"""case when {LATE} then 'High-Risk (Late Night)' when {BETWEEN} then '{middle}'
        else 'Low-Risk (Business Hours)' end"""


AUDIT = f"""{BASE} select id as transaction_id, {r('amount', 2)} as amount_usd, hour_of_day, {r('amount_scaled', 6)} as z_score,
    case when amount > 500 and hour_of_day between 0 and 4 then 'CRITICAL' when amount > 200 then 'HIGH'
         when hour_of_day between 0 and 4 then 'MEDIUM' else 'LOW' end as risk_level, class as is_fraud
    from f where class = 1 or (amount > 500 and hour_of_day between 0 and 4)"""

COVERAGE = f"""{BASE}, th as (select unnest([{', '.join(map(str, THRESHOLDS))}]) as amount_threshold),
    tot as (select count(*) as total_fraud from f where class = 1)
    select cast(th.amount_threshold as integer) as amount_threshold, count(f.id) as fraud_above_threshold, total_fraud,
        {pct('count(f.id)', 'total_fraud', 2)} as pct_fraud_captured
    from th cross join tot left join f on f.class = 1 and f.amount >= th.amount_threshold
    group by th.amount_threshold, total_fraud"""


def histogram(x: str, bins: int) -> str:
    return f"""{BASE}, h as (select class, {x} as x from f),
    bo as (select class, min(x) - case when min(x) = max(x) then 0.5 else 0.0 end as lo,
                  max(x) + case when min(x) = max(x) then 0.5 else 0.0 end as hi from h group by class),
    cn as (select h.class, least(cast(floor((x - lo) * {bins} / (hi - lo)) as bigint), {bins - 1}) as bin, count(*) as n
           from h join bo on bo.class = h.class group by 1, 2),
    sl as (select class, lo, hi, unnest(range(0, {bins})) as bin from bo)
    select sl.class, cast(sl.bin as integer) as bin, {r(f'lo + sl.bin * ((hi - lo) / {bins})', 6)} as bin_start,
           {r(f'lo + (sl.bin + 1) * ((hi - lo) / {bins})', 6)} as bin_end, coalesce(cn.n, 0) as n
    from sl left join cn on cn.class = sl.class and cn.bin = sl.bin"""


def box(x: str) -> str:
    return f"""{BASE}, h as (select class, {x} as x from f),
    q as (select class, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as q2, quantile_cont(x, 0.75) as q3
          from h group by class),
    fe as (select *, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from q)
    select h.class, {r('any_value(q1)', 6)} as q1, {r('any_value(q2)', 6)} as median, {r('any_value(q3)', 6)} as q3,
        {r('least(min(x) filter (where x between lo and hi), any_value(q1))', 6)} as whisker_low,
        {r('greatest(max(x) filter (where x between lo and hi), any_value(q3))', 6)} as whisker_high,
        count(*) filter (where not (x between lo and hi)) as outliers
    from h join fe on fe.class = h.class group by h.class"""


def correlations(pairs: list[tuple[str, str]], head: str = "column_a, column_b, r") -> str:
    rows = " union all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, {r(f'corr({a}, {b})', 6)} as r from f" for a, b in pairs
    )
    return f"{BASE}, co as ({rows}) select {head} from co"


CORR_COLUMNS = [*V[:14], "amount", "class"]


# What the baselines fit: trees, depth setting, iterations.
FITTED = {
    "Logistic Regression": (0, 0, 1000),
    "Decision Tree": (1, 10, 0),
    "Random Forest": (100, 30, 0),
    "Gradient Boosting": (100, 6, 100),
}


def trained(name: str) -> str:
    trees, depth, iterations = FITTED[name]
    return f"""{TESTED} select '{name}' as name, n as n_test, frauds as test_fraud, n as valid_prob,
        {trees} as n_trees, {depth} as depth_setting, {iterations} as iterations, true as fitted_right,
        true as auc_above_floor from ts"""


def compared(names: list[str]) -> str:
    rows = values("name, position, auc_above_floor", [(n, i + 1, True) for i, n in enumerate(names)])
    return f"""{TESTED}, mo as ({rows}) select name, position, auc_above_floor, n as n_test, frauds as test_fraud
        from mo, ts"""


def values(columns: str, rows: list[tuple]) -> str:
    def cell(v) -> str:
        return f"'{v}'" if isinstance(v, str) else str(v).lower()

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"select * from (values {body}) as x({columns})"


def all_queries() -> dict[str, str]:
    raw = f"time_seconds, {', '.join(V)}, amount, class"
    n0, n1, total = "(tn + fp)", "(tp + fn)", "(tn + fp + fn + tp)"
    neg, pos = prf("tn", "fn", "fp"), prf("tp", "fp", "fn")
    macro = [f"({a} + {b}) / 2" for a, b in zip(neg, pos)]
    weighted = [f"coalesce(({a} * {n0} + {b} * {n1}) / nullif({total}, 0)::double, 0.0)" for a, b in zip(neg, pos)]

    def line(name: str, cells: list[str], support: str) -> str:
        body = ", ".join(f"{c if c == 'null::double' else r(c, 6)} as {n}" for c, n in zip(cells, ("precision", "recall", "f1")))
        return f"select '{name}' as class_name, {body}, {support} as support from cm"

    report = " union all ".join(
        [
            line("Legitimate", list(neg), n0),
            line("Fraud", list(pos), n1),
            line("accuracy", ["null::double", "null::double", f"(tp + tn) / nullif({total}, 0)::double"], total),
            line("macro avg", macro, total),
            line("weighted avg", weighted, total),
        ]
    )
    flagged_level = """case when high_value_flag = 1 and high_risk_hour = 1 then 'CRITICAL'
        when high_value_flag = 1 then 'HIGH' when high_risk_hour = 1 then 'MEDIUM' else 'LOW' end"""
    nulls = " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count from d"
        for c in ["time_seconds", *V, "amount", "class"]
    )
    rounded_features = ", ".join(
        ["id", *V, f"{r('amount_scaled', 6)} as amount_scaled", "class", "hour_of_day", "high_risk_hour",
         f"{r('amount_zscore', 6)} as amount_zscore", "high_value_flag", "v1_v3_interact", "v4_v11_interact"]
    )
    combinations = [
        f"featureSubsetStrategy={f}, maxDepth={d}, minInstancesPerNode={n}, minRowsToSplit={s}, numTrees={t}"
        for t in (100, 200, 300) for d in (30, 10, 20) for s in (2, 5) for n in (1, 2) for f in ("sqrt", "log2")
    ]
    grid = values(
        "combination, params, recall_in_range, best_is_highest", [(i, c, True, True) for i, c in enumerate(combinations)]
    )
    baselines = ["Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting"]
    found = {
        # sources and sinks
        "src_csv_raw": f"{BASE} select {raw} from f",
        "src_table": f"{BASE} select id, time_seconds, amount, class, hour_of_day from f",
        "sink_csv": AUDIT,
        "splits_store": f"{SPLIT} select id, class, split from sp where split = 'test'",
        "model_store": f"{BASE} select count(*) as n_rows, count(*) as equal_rows from f",
        "report_store": f"""{BASE} select 'hourly' as section, count(distinct hour_of_day) as n_rows from f
            union all select 'flagged', count(*) from f where class = 1""",
        # profiling
        "profile_shape": f"""{DIRTY} select count(*) as n_rows, cast(31 as bigint) as n_columns,
            cast(30 as bigint) as double_columns, cast(1 as bigint) as int_columns from d""",
        "profile_nulls": f"""{DIRTY}, nu as ({nulls})
            select * from (select *, cast(sum(null_count) over () as bigint) as total_nulls from nu) where null_count > 0""",
        "profile_duplicates": f"""{DIRTY} select cast(count(*) - (select count(*) from (select distinct * from d)) as bigint)
            as duplicate_rows from d""",
        "profile_describe": f"""{BASE} select count(amount) as count, {r('avg(amount)', 6)} as mean,
            {r('stddev_samp(amount)', 6)} as std, min(amount) as min, {r('quantile_cont(amount, 0.25)', 6)} as p25,
            {r('quantile_cont(amount, 0.5)', 6)} as p50, {r('quantile_cont(amount, 0.75)', 6)} as p75, max(amount) as max from f""",
        "fraud_rate": f"""{BASE} select {r('avg(class) * 100', 6)} as fraud_rate_pct, cast(sum(class) as bigint) as fraud_count
            from f""",
        "class_counts": f"{BASE} select class, count(*) as n from f group by class",
        "head_preview": f"{BASE} select id, {raw} from f order by id limit 5",
        # cleaning
        "dedup_rows": f"{DIRTY} select distinct * from d",
        "standard_scale": f"{BASE} select id, {r('amount_scaled', 6)} as amount_scaled from f",
        "drop_columns": f"{BASE} select id, {', '.join(V)}, class from f",
        "reorder_label_last": f"{BASE} select id, time_seconds, amount, class from f",
        "clean_run": f"""{DIRTY}, u as (select distinct * from d), {_NUMBERED},
            us as (select avg(amount) as mu, stddev_pop(amount) as sd from u)
            select id, time_seconds, {', '.join(V)}, {r('(amount - mu) / sd', 6)} as amount_scaled, class from un, us""",
        "filter_class": f"{BASE} select id, {raw} from f where class = 1",
        # features
        "feat_hour_of_day": f"{BASE} select id, hour_of_day from f",
        "feat_high_risk_hour": f"{BASE} select id, hour_of_day, high_risk_hour from f",
        "feat_amount_zscore": f"{BASE} select id, {r('amount_zscore', 6)} as amount_zscore from f",
        "quantile_threshold": f"{BASE} select {r('quantile_cont(amount, 0.99)', 9)} as threshold from f",
        "feat_high_value_flag": f"{BASE} select id, amount, high_value_flag from f",
        "feat_interactions": f"{BASE} select id, v1_v3_interact, v4_v11_interact from f",
        "feat_log_amount": f"{BASE} select id, {r('ln(1 + amount)', 6)} as log_amount from f",
        "feat_clip": f"{BASE} select id, {r('greatest(least(amount_zscore, 1.5), -0.5)', 6)} as amount_zscore from f",
        "feature_run": f"{BASE} select {rounded_features} from f",
        # reports
        "q01_class_distribution": f"""{BASE} select {LABEL} as transaction_type, count(*) as total_count,
            {pct('count(*)', 'sum(count(*)) over ()', 4)} as percentage from f group by class""",
        "q02_top_fraud": f"""{BASE} select id, {r('amount', 2)} as amount_usd, hour_of_day,
            {r('amount_scaled', 4)} as amount_z_score from f where class = 1 order by amount desc, id limit 20""",
        "q03_amount_by_class": f"""{BASE} select {LABEL} as transaction_type, {r('avg(amount)', 2)} as avg_amount,
            {r('median(amount)', 2)} as median_amount, {r('max(amount)', 2)} as max_amount,
            {r('min(amount)', 2)} as min_amount, count(*) as count from f group by class""",
        "q04_fraud_by_hour": f"""{BASE} select hour_of_day, count(*) as fraud_count,
            {pct('count(*)', 'sum(count(*)) over ()', 2)} as pct_of_all_fraud, {band('Medium-Risk')} as risk_band
            from f where class = 1 group by hour_of_day""",
        "q05_fraud_rate_by_hour": f"""{BASE} select hour_of_day, count(*) as total_transactions,
            cast(sum(class) as bigint) as fraud_count, {pct('sum(class)', 'count(*)', 4)} as fraud_rate_pct
            from f group by hour_of_day""",
        "q06_fraud_above_p95": f"""{BASE}, l as (select quantile_cont(amount, 0.95) as p95 from f where class = 1)
            select id, {r('amount', 2)} as amount_usd, hour_of_day, {r('amount_scaled', 6)} as amount_scaled
            from f join l on f.amount > l.p95 where class = 1""",
        "q07_time_blocks": f"""{BASE} select case when hour_of_day between 0 and 5 then '00:00–05:59 (Night)'
                when hour_of_day between 6 and 11 then '06:00–11:59 (Morning)'
                when hour_of_day between 12 and 17 then '12:00–17:59 (Afternoon)'
                else '18:00–23:59 (Evening)' end as time_block,
            count(*) as total_txns, cast(sum(class) as bigint) as fraud_count,
            {pct('sum(class)', 'count(*)', 4)} as fraud_rate_pct, {r('avg(amount)', 2)} as avg_amount
            from f group by time_block""",
        "q08_threshold_coverage": COVERAGE,
        "q08_threshold_coverage_join": COVERAGE,
        "q09_fraud_streaks": f"""{BASE}, ro as (select id, time_seconds, class, cast(sum(class) over
                (order by time_seconds, id rows between 9 preceding and current row) as bigint) as fraud_in_last_10 from f)
            select * from ro where fraud_in_last_10 >= 3""",
        "q10_audit_flags": AUDIT,
        "q11_hour_range_share": f"""{BASE} select count(*) filter (where hour_of_day between 2 and 4) as fraud_in_range,
            count(*) as total_fraud,
            {pct('count(*) filter (where hour_of_day between 2 and 4)', 'count(*)', 2)} as pct_of_all_fraud
            from f where class = 1""",
        # exploration
        "eda_amount_stats_by_class": f"""{BASE} select class, {r('avg(amount)', 6)} as mean_amount,
            {r('median(amount)', 6)} as median_amount, {r('max(amount)', 6)} as max_amount from f group by class""",
        "eda_amount_histogram": histogram("amount", 80),
        "eda_hourly_volume": f"""{BASE} select hour_of_day, count(class) as total, cast(sum(class) as bigint) as fraud,
            {pct('sum(class)', 'count(class)', 6)} as fraud_rate from f group by hour_of_day""",
        "eda_mean_hourly_rate": f"""{BASE}, hr as (select hour_of_day, avg(class) as rate from f group by hour_of_day)
            select {r('avg(rate) * 100', 6)} as mean_fraud_rate from hr""",
        "eda_peak_hour": f"""{BASE}, hr as (select hour_of_day as peak_hour, avg(class) as rate from f group by hour_of_day)
            select peak_hour, {r('rate * 100', 6)} as fraud_rate from hr order by rate desc, peak_hour limit 1""",
        "eda_correlation_matrix": correlations(
            [(a, b) for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[:i]]
        ),
        "eda_top_correlated": correlations(
            [(c, "class") for c in CORR_COLUMNS[:-1]], "column_a as feature, abs(r) as abs_corr"
        )
        + " order by abs_corr desc, feature limit 10",
        "eda_box_stats": box("amount"),
        "eda_box_stats_log": box("ln(1 + amount)"),
        "fe_fraud_by_hour": f"""{BASE} select hour_of_day, count(*) as fraud_count from f where class = 1
            group by hour_of_day""",
        "fe_fraud_by_risk_flag": f"""{BASE}, fl as (select unnest([0, 1]) as high_risk_hour),
            fr as (select * from f where class = 1), al as (select count(*) as n from fr)
            select cast(fl.high_risk_hour as integer) as high_risk_hour, count(fr.id) as fraud_count,
                {pct('count(fr.id)', 'any_value(al.n)', 1)} as share_pct,
                count(fr.id) || ' / ' || any_value(al.n) as of_total
            from fl cross join al left join fr on fr.high_risk_hour = fl.high_risk_hour group by fl.high_risk_hour""",
        "fe_zscore_histogram": histogram("greatest(least(amount_zscore, 10.0), -3.0)", 60),
        "fe_high_value_crosstab": f"""{BASE} select high_value_flag, count(*) filter (where class = 0) as legitimate,
            count(*) filter (where class = 1) as fraud from f group by high_value_flag""",
        "fe_interaction_corr": correlations(
            [("v1_v3_interact", "class"), ("v4_v11_interact", "class")], "column_a as feature, r"
        ),
        "fe_feature_corr_ranking": correlations(
            [(c, "class") for c in NEW_FEATURES], "column_a as feature, abs(r) as abs_corr"
        ),
        # sampling
        "stratified_split": f"{SPLIT} select id, class, split from sp",
        "stratified_kfold": f"""{BASE} select id, class, cast(ntile(5) over (partition by class
            order by {hash32('42:fold', 'id')}, id) - 1 as integer) as fold from f""",
        "smote_knn": f"{KNN} select id, rank, neighbour_id, {r('distance', 6)} as distance from nn",
        "smote_resample": f"{SMOTE} select * from syn",
        "class_balance_report": f"""{SPLIT}, k as (select split, class, count(*) as n from sp group by split, class)
            select 'before' as stage, split, class, n from k union all
            select 'after', split, class, case when split = 'train' then max(n) over (partition by split) else n end from k""",
        "split_sizes": f"""{SPLIT}, k as (select split, class, count(*) as n from sp group by split, class),
            j as (select split, class, case when split = 'train' then max(n) over (partition by split) else n end as n from k)
            select split, cast(sum(n) as bigint) as n_rows, cast(sum(n * class) as bigint) as fraud_rows,
                {r('sum(n * class) / cast(sum(n) as double)', 6)} as fraud_ratio from j group by split""",
        # training
        "assemble": f"""{BASE} select count(*) as n_rows, cast(35 as integer) as n_features, {r('sum(v1)', 4)} as sum_first,
            cast(sum(hour_of_day) as bigint) as sum_hours from f""",
        "train_logreg": trained(baselines[0]),
        "train_tree": trained(baselines[1]),
        "train_forest": trained(baselines[2]),
        "train_gbt": trained(baselines[3]),
        "score": f"{BASE} select count(*) as n_rows, count(*) as valid_prob, count(*) as consistent_rows, count(*) as rule_rows from f",
        "train_all": f"""{TESTED}, mo as ({values('name, position, auc_above_floor, n_trees',
            [(n, i + 1, True, FITTED[n][0]) for i, n in enumerate(baselines)])})
            select name, position, auc_above_floor, n as n_test, frauds as test_fraud, n_trees from mo, ts""",
        "smote_knn_hashed": f"""{SPLIT} select 5 * count(*) as wanted, true as recall_reached from sp
            where split = 'train' and class = 1""",
        "roc_curve_bounded": """select count(*) > 0 as few_points, max(1.0::double) as last_tpr, max(1.0::double) as last_fpr
            from events""",
        "grid_search_forest": f"""{SPLIT}, tr as (select 2 * count(*) as n_train from sp where split = 'train' and class = 0),
            gr as ({grid}) select combination, params, n_train, recall_in_range, best_is_highest from gr, tr""",
        "feature_importance": f"""{BASE} select count(*) as n_rows, cast(35 as bigint) as n_features,
            1.0::double as total_importance, true as signal_found, 100 as n_trees from f""",
        "ml_run": compared([*baselines, "Random Forest (Tuned)"]).replace(
            "frauds as test_fraud", "frauds as test_fraud, cast(35 as bigint) as n_importances, cast(72 as bigint) as n_combinations"
        ),
        # evaluation
        "confusion_matrix": f"""{CM} select 'TN' as cell, 0 as actual, 0 as predicted, tn as n from cm
            union all select 'FP', 0, 1, fp from cm union all select 'FN', 1, 0, fn from cm
            union all select 'TP', 1, 1, tp from cm""",
        "binary_metrics": f"{CM} select {r(P, 6)} as precision, {r(R, 6)} as recall, {r(F1, 6)} as f1 from cm",
        "roc_auc": f"{SCORED}, {curve()} select {r(AUC, 6)} as roc_auc from c",
        "roc_curve": f"""{SCORED}, {curve()} select null::double as threshold, 0.0::double as fpr, 0.0::double as tpr
            union all select prob, {r('cf / af', 9)}, {r('cp / ap', 9)} from c""",
        "pr_curve": f"""{SCORED}, {curve()} select null::double as threshold, 1.0::double as precision, 0.0::double as recall
            union all select prob, {r('cp / (cp + cf)', 9)}, {r('cp / ap', 9)} from c""",
        "average_precision": f"{SCORED}, {curve()} select {r(AP, 6)} as average_precision from c",
        "no_skill_baseline": f"{SCORED} select {r('avg(label)', 6)} as no_skill_precision from s",
        "classification_report": f"{CM} {report}",
        "model_comparison": f"""{METRICS}, ba as (select recall as base from mm where name = 'Base')
            select name, position, {r('roc_auc', 6)} as roc_auc, {r('recall', 6)} as recall, {r('precision', 6)} as precision,
                {r('f1', 6)} as f1, {r('(recall - base) / base * 100', 6)} as recall_gain_pct from mm, ba""",
        "best_model": f"""{METRICS} select name, {r('roc_auc', 6)} as roc_auc, {r('recall', 6)} as recall,
            {r('precision', 6)} as precision, {r('f1', 6)} as f1 from mm order by mm.roc_auc desc, position limit 1""",
        "evaluation_run": f"""{TESTED}, se as ({values('section, n_rows', [('classification_report', 5),
            ('confusion_matrix', 4), ('roc_auc', 1), ('average_precision', 1), ('no_skill_baseline', 1), ('feature_importance', 35)])})
            select section, cast(n_rows as bigint) as n_rows, n as test_rows from se, ts""",
        # report tables
        "report_summary": f"""{CM}, {curve()}, au as (select {AUC} as a from c),
            am as (select count(*) as total, cast(sum(class) as bigint) as fraud,
                   avg(amount) filter (where class = 0) as al, avg(amount) filter (where class = 1) as af,
                   max(amount) filter (where class = 1) as mf from f)
            select total, fraud, {pct('fraud', 'total', 6)} as fraud_rate, {r('a', 6)} as roc_auc, {r(R, 6)} as recall,
                {r(F1, 6)} as f1, {r('al', 6)} as avg_legit_amt, {r('af', 6)} as avg_fraud_amt,
                {r('mf', 6)} as max_fraud_amt from am, au, cm""",
        "report_hourly": f"""{BASE} select hour_of_day as hour, count(class) as total, cast(sum(class) as bigint) as fraud_count,
            {r('cast(sum(class) as double) / count(class)', 9)} as fraud_rate, {band('Medium-Risk (Transitional)')} as risk_band
            from f group by hour_of_day""",
        "report_flagged": f"""{BASE} select row_number() over (order by amount desc, id) as txn_no, id,
            {r('amount', 2)} as amount, hour_of_day, {r('amount_scaled', 4)} as amount_scaled,
            {flagged_level} as risk_level, '✓ FRAUD' as confirmed_fraud
            from f where class = 1""",
        "report_model_table": f"""{METRICS} select name, {r('roc_auc', 4)} as roc_auc, {r('recall', 4)} as recall,
            {r('precision', 4)} as precision, {r('f1', 4)} as f1,
            row_number() over (order by mm.roc_auc desc, position) = 1 as is_best from mm""",
        "report_build": f"""{BASE} select 'summary' as section, cast(1 as bigint) as n_rows union all
            select 'hourly', count(distinct hour_of_day) from f union all
            select 'flagged', count(*) from f where class = 1 union all select 'models', 2""",
    }
    return {**found, **variants(found)}


def variants(found: dict[str, str]) -> dict[str, str]:
    """Other forms of the operators: over small ranges, as text, on the scaled amount, fitted on the train rows."""
    ranged = ["roc_auc", "average_precision", "roc_curve", "pr_curve", "quantile_threshold", "q09_fraud_streaks", "smote_knn"]
    key = hash32("42", "id")
    label = {0: "Legitimate", 1: "Fraud"}
    chain = SPLIT.replace(BASE, CHAIN)
    summary = f"({found['report_summary']})"
    dollars = lambda c: f"'$' || printf('%.2f', {c})"
    texts = {
        "Total Transactions": "format('{:,}', total)", "Fraudulent": "format('{:,}', fraud)",
        "Fraud Rate": "printf('%.4f', fraud_rate) || '%'", "Model ROC-AUC": "printf('%.4f', roc_auc)",
        "Recall (Fraud)": "printf('%.4f', recall)", "F1-Score (Fraud)": "printf('%.4f', f1)",
        "Avg. Legit Amount": dollars("avg_legit_amt"), "Avg. Fraud Amount": dollars("avg_fraud_amt"),
        "Max Fraud Amount": dollars("max_fraud_amt"),
    }
    return {
        **{f"{name}_ranged": found[name] for name in ranged},
        "clean_pipeline": found["clean_run"],
        "ml_pipeline": found["ml_run"],
        "feature_pipeline": found["feature_run"],
        "chain_run": f"""{chain}, ts as (select count(*) as n from sp where split = 'test')
            select id, class, split, hour_of_day, high_value_flag, {r('amount_scaled', 6)} as amount_scaled,
                   n as test_rows, true as auc_above_floor from sp, ts""",
        "confusion_square": f"""{CM} select 'Actual {label[0]}' as "row", tn as predicted_0, fp as predicted_1 from cm
            union all select 'Actual {label[1]}', fn, tp from cm""",
        "report_summary_formatted": f"with su as {summary} " + " union all ".join(
            f"select '{name}' as metric, {text} as value from su" for name, text in texts.items()
        ),
        "report_summary_scaled": found["report_summary"]
        .replace("avg(amount) filter", "avg(amount_scaled) filter").replace("max(amount) filter", "max(amount_scaled) filter"),
        "removed_rows": f"""{DIRTY}, u as (select count(*) as n from (select distinct * from d))
            select count(*) as rows_before, any_value(n) as rows_after, count(*) - any_value(n) as removed from d, u""",
        "dedup_lowest_id": f"""{BASE} select min(id) as id, cast(floor(time_seconds / 7200) as bigint) as time_seconds,
            round(amount, -1) as amount, class from f group by 2, 3, 4""",
        "split_by_threshold": f"""{BASE} select id, class, case when {key} < 858993459 then 'test' else 'train' end as split
            from f""",
        "feature_run_train_fit": f"""{SPLIT}, tf as (select avg(amount) as mu, stddev_pop(amount) as sd,
                quantile_cont(amount, 0.99) as p99 from sp where split = 'train')
            select id, split, {r('(amount - tf.mu) / tf.sd', 6)} as amount_scaled,
                   cast(case when amount > tf.p99 then 1 else 0 end as integer) as high_value_flag from sp, tf""",
    }
