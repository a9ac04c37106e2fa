"""The same queries in DuckDB's SQL, for those that SQL can express on whole tables."""

from __future__ import annotations

from itertools import combinations

from tabwright.checks.queries import (
    ALERT_CATEGORICAL,
    ALERT_NUMERIC,
    ALERT_THRESHOLDS,
    CATEGORICAL,
    LINE_NUMBERS,
    NUMERIC,
    THRESHOLDS,
)
from tabwright.plans.training import SEED_PARAMETERS

FEATURES = ", ".join([*NUMERIC, *CATEGORICAL])


def h(text: str) -> str:
    """The first 32 bits of the text's md5 as a number."""
    return f"('0x' || substr(md5({text}), 1, 8))::bigint"


def sig(x: str) -> str:
    return f"case when ({x}) is not null then cast(printf('%.6e', ({x})::double * 1.0000000001e0) as double) end"


def split(key: str, weights: list[float], names: list[str], seed: int = 42) -> str:
    total, upto, cases = float(sum(weights)), 0.0, []
    u = f"({h(f"concat_ws(':', '{seed}', {key})")} / 4294967296e0)"
    for weight, name in zip(weights[:-1], names[:-1]):
        upto += weight
        cases.append(f"when {u} < {upto / total!r}::double then '{name}'")
    return f"case {' '.join(cases)} else '{names[-1]}' end"


ORDERS = f"""
feats as materialized (
  with base as (
    select o.o_orderkey, o.o_custkey as entity_id, o.o_orderdate as ts,
           o.o_totalprice, c.c_acctbal, a.n_lines, a.sum_qty,
           a.avg_discount, a.avg_tax, a.avg_size, a.avg_retail,
           o.o_orderstatus, o.o_orderpriority, c.c_mktsegment, n.n_name,
           r.r_name, a.ptype, a.rflag, a.lstat
    from orders o
    join customer c on o.o_custkey = c.c_custkey
    join nation n on c.c_nationkey = n.n_nationkey
    join region r on n.n_regionkey = r.r_regionkey
    left join (select l_orderkey, count(*) as n_lines, sum(l_quantity) as sum_qty,
                      round(avg(l_discount), 6) as avg_discount, round(avg(l_tax), 6) as avg_tax,
                      round(avg(p_size), 6) as avg_size, round(avg(p_retailprice), 6) as avg_retail,
                      min(p_type) as ptype, max(l_returnflag) as rflag, min(l_linestatus) as lstat
               from lineitem join part on l_partkey = p_partkey
               group by l_orderkey) a on o.o_orderkey = a.l_orderkey)
  select *, cast(case when coalesce(sum_qty, 0) + (case when o_orderstatus = 'F' then 40 else 0 end)
                 - o_totalprice / 10000 + {h("o_orderkey::varchar")} % 40 > 80
            then 1 else 0 end as integer) as label
  from base)
"""

SCORED = """
scored as (
  select *, cast(case when event_type = 'purchase' then 0 else 1 end as integer) as label,
         1.0e0 / (1.0e0 + exp(-((value - 50) / 50))) as p_one,
         cast(case when value > 50 then 1 else 0 end as integer) as prediction,
         cast(case when value > 20 then 1 else 0 end as integer) as rival_prediction
  from events)
"""


def ratio(a: str, b: str) -> str:
    return f"coalesce(({a})::double / nullif({b}, 0), 0.0e0)"


def class_metrics(
    source: str, prediction: str = "prediction", label: str = "label", by: str = "", name: str = ""
) -> str:
    """A select of precision, recall and f1 of class 0."""
    lead = f"{by}, " if by else f"'{name}' as name, " if name else ""
    p, r = ratio("tp", "tp + fp"), ratio("tp", "tp + fn")
    return f"""
      select {lead}p as precision, r as recall, {ratio("2.0e0 * p * r", "p + r")} as f1
      from (select *, {p} as p, {r} as r from (
        select {by + ", " if by else ""}
               count(*) filter ({label} = 0 and {prediction} = 0) as tp,
               count(*) filter ({label} = 1 and {prediction} = 0) as fp,
               count(*) filter ({label} = 0 and {prediction} = 1) as fn
        from {source} {"group by " + by if by else ""}))"""


def sig_metrics(inner: str, lead: str = "") -> str:
    return (
        f"select {lead} {sig('precision')} as precision, {sig('recall')} as recall, "
        f"{sig('f1')} as f1 from ({inner})"
    )


def evaluation(source: str, label: str, prediction: str) -> str:
    return f"""
      select true_negatives, false_positives, false_negatives, true_positives, example_count,
             {sig(ratio("true_positives + true_negatives", "example_count"))} as accuracy_score,
             {sig("r")} as recall_score, {sig("p")} as precision_score,
             {sig(ratio("2.0e0 * p * r", "p + r"))} as f1_score
      from (select *, {ratio("true_positives", "true_positives + false_positives")} as p,
                   {ratio("true_positives", "true_positives + false_negatives")} as r
            from (select count(*) filter ({label} = 1 and {prediction} = 1) as true_negatives,
                         count(*) filter ({label} = 1 and {prediction} = 0) as false_positives,
                         count(*) filter ({label} = 0 and {prediction} = 1) as false_negatives,
                         count(*) filter ({label} = 0 and {prediction} = 0) as true_positives,
                         count(*) filter ({label} is not null and {prediction} is not null)
                           as example_count
                  from {source}))"""


def union(parts) -> str:
    return " union all ".join(f"({p})" for p in parts)


def threshold_metrics() -> str:
    return union(
        class_metrics(
            "scored", f"(case when value > {t} then 1 else 0 end)", name=f"threshold_{t}"
        )
        for t in THRESHOLDS
    )


PURCHASES = "(select event_id, user_id, ts from events where event_type = 'purchase')"
VIEWS = (
    "(select user_id, ts, value as last_value, props as last_props from events "
    "where event_type = 'view')"
)
PIT = f"""
  select f.event_id, f.user_id, f.ts, v.last_value, v.last_props, v.ts as feature_ts
  from {PURCHASES} f asof left join {VIEWS} v on f.user_id = v.user_id and f.ts >= v.ts"""
LATE_LABELS = """
  (select event_id, ts + interval 2 hours as label_ts,
          cast(case when hour(ts) < 12 then 0 else 1 end as integer) as true_label
   from events where event_type = 'purchase')"""


# --- profile -------------------------------------------------------------------------


def numeric_stats(c: str, source: str) -> str:
    return f"""
      select '{c}' as "column", count(x) as count, count(*) - count(x) as missing,
             count(distinct x) as distinct_values, count(*) filter (x = 0) as zeros,
             count(*) filter (x < 0) as negatives, avg(x) as mean, stddev_samp(x) as std,
             var_samp(x) as variance, stddev_samp(x) / nullif(avg(x), 0) as cv,
             min(x) as min, max(x) as max, max(x) - min(x) as range, sum(x) as sum, mad(x) as mad,
             avg((x - m) ** 3) / nullif(avg((x - m) ** 2) ** 1.5, 0) as skewness,
             kurtosis_pop(x) as kurtosis
      from (select {c}::double as x, avg({c}::double) over () as m from {source})"""


STAT_DOUBLES = (
    "mean", "std", "variance", "cv", "min", "max", "range", "sum", "mad", "skewness", "kurtosis",
)


def quantiles(columns, source: str) -> str:
    def one(c: str) -> str:
        picks = [f"quantile_cont({c}::double, {p}) as q{n}" for n, p in
                 (("05", 0.05), ("25", 0.25), ("50", 0.5), ("75", 0.75), ("95", 0.95))]
        return f"select '{c}' as \"column\", {', '.join(picks)} from {source}"

    names = ["q05", "q25", "q50", "q75", "q95"]
    shown = ", ".join(f"{sig(n)} as {n}" for n in names)
    return (
        f"select \"column\", {shown}, {sig('q75 - q25')} as iqr from ({union(map(one, columns))})"
    )


def bin_of(c: str, bins: int = 10) -> str:
    """The equal-width bin of a number column, over the whole source."""
    lo, hi = f"min({c}::double) over ()", f"max({c}::double) over ()"
    return (
        f"case when {c} is not null then cast(least(coalesce(floor(({c}::double - {lo}) * "
        f"{bins}.0e0 / nullif({hi} - {lo}, 0)), 0), {bins - 1}) as integer) end"
    )


def histogram(c: str, source: str) -> str:
    return f"""
      select '{c}' as "column", bin, count(*) as n
      from (select {bin_of(c)} as bin from {source}) where bin is not null group by bin"""


def categorical_stats(c: str, source: str) -> str:
    return f"""
      select '{c}' as "column", sum(n)::bigint as count, count(*) as distinct_values,
             arg_min(value, (-n, value)) as mode, max(n) as mode_count,
             case when count(*) > 1 then 1 - (ln(sum(n)) - sum(n * ln(n)) / sum(n)) / ln(count(*))
                  else 0 end as imbalance
      from (select {c}::varchar as value, count(*) as n from {source}
            where {c} is not null group by 1)"""


def top_values(c: str, source: str, k: int) -> str:
    return f"""
      select '{c}' as "column", place, value, n, n / total as share
      from (select *, row_number() over (order by n desc, value) as place, sum(n) over () as total
            from (select {c}::varchar as value, count(*) as n from {source}
                  where {c} is not null group by 1))
      where place <= {k}"""


def text_lengths(c: str, source: str) -> str:
    return f"""
      select '{c}' as "column", min(length({c}))::integer as min_length,
             {sig(f"avg(length({c}))")} as mean_length, {sig(f"quantile_cont(length({c})::double, 0.5)")}
             as median_length, max(length({c}))::integer as max_length from {source}"""


def overview(columns: dict[str, int], names: str, source: str) -> str:
    width = sum(columns.values())
    missing = " + ".join(f"count(*) filter ({c} is null)" for c in names.split(", "))
    kinds = ", ".join(f"{n}::bigint as {k}_columns" for k, n in columns.items())
    return f"""
      select rows, {width}::bigint as columns, missing_cells,
             {sig(ratio("missing_cells", f"rows * {width}"))} as missing_share,
             duplicate_rows, {sig(ratio("duplicate_rows", "rows"))} as duplicate_share, {kinds}
      from (select count(*) as rows, {missing} as missing_cells,
                   count(*) - (select count(*) from (select distinct {names} from {source}))
                     as duplicate_rows
            from {source})"""


def missing_count(c: str, source: str) -> str:
    return f"""
      select '{c}' as "column", count(*) filter ({c} is null) as missing,
             {sig(ratio(f"count(*) filter ({c} is null)", "count(*)"))} as share from {source}"""


# --- correlations --------------------------------------------------------------------


def corr(x: str, y: str) -> str:
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


def pearson(a: str, b: str, source: str) -> str:
    return f"""
      select '{a}' as left_col, '{b}' as right_col, {sig(corr("x", "y"))} as pearson
      from (select {a}::double as x, {b}::double as y from {source}
            where {a} is not null and {b} is not null)"""


def spearman(a: str, b: str, source: str) -> str:
    def rank(c: str) -> str:
        return f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0e0"

    return f"""
      select '{a}' as left_col, '{b}' as right_col, {sig(corr("rx", "ry"))} as spearman
      from (select {rank("x")} as rx, {rank("y")} as ry
            from (select {a}::double as x, {b}::double as y from {source}
                  where {a} is not null and {b} is not null))"""


def kendall(a: str, b: str, source: str) -> str:
    """Running counts along ``x`` at every level of ``y``; ``y`` is the column of fewer levels."""
    return f"""
      select '{a}' as left_col, '{b}' as right_col,
             {sig("s / (sqrt(pairs - tx) * sqrt(pairs - ty))")} as kendall
      from (with rows_of as materialized (
              select {a}::double as p, {b}::double as q from {source}
              where {a} is not null and {b} is not null),
            few as materialized (select count(distinct p) < count(distinct q) as turned from rows_of),
            cells as materialized (
              select case when turned then q else p end as x, case when turned then p else q end as y,
                     count(*)::double as n from rows_of, few group by 1, 2),
            grid as (
              select x, y, coalesce(n, 0) as n from (select distinct x from cells) g
              join (select distinct y from cells) h on true left join cells using (x, y)),
            along as (
              select x, y, n, coalesce(sum(n) over (partition by y order by x
                rows between unbounded preceding and 1 preceding), 0) as before from grid),
            around as (
              select n, coalesce(sum(before) over (partition by x order by y
                       rows between unbounded preceding and 1 preceding), 0) as less,
                     coalesce(sum(before) over (partition by x order by y
                       rows between 1 following and unbounded following), 0) as more from along)
            select (select sum(n * (less - more)) from around where n > 0) as s,
                   (select sum(n) * (sum(n) - 1) / 2 from cells) as pairs,
                   (select sum(n * (n - 1) / 2) from (select sum(n) as n from cells group by x)) as tx,
                   (select sum(n * (n - 1) / 2) from (select sum(n) as n from cells group by y)) as ty)"""


def cramers(a: str, b: str, source: str, corrected: bool = False) -> str:
    phi2, r, c = "greatest(share - 1, 0)", "r", "c"
    if corrected:
        phi2 = f"greatest({phi2} - (r - 1) * (c - 1) / (n - 1), 0)"
        r, c = "(r - (r - 1) ** 2 / (n - 1))", "(c - (c - 1) ** 2 / (n - 1))"
    return f"""
      select '{a}' as left_col, '{b}' as right_col,
             {sig(f"sqrt({phi2} / nullif(least({r}, {c}) - 1, 0))")} as cramers_v
      from (select sum(o * o / (row_n * column_n)) as share, sum(o) as n,
                   count(distinct x)::double as r, count(distinct y)::double as c
            from (select x, y, o, sum(o) over (partition by x) as row_n,
                         sum(o) over (partition by y) as column_n
                  from (select {a} as x, {b} as y, count(*)::double as o from {source}
                        where {a} is not null and {b} is not null group by 1, 2)))"""


def contingency(a: str, b: str, left: str, right: str, source: str) -> str:
    return f"""
      select '{left}' as left_col, '{right}' as right_col, sum(o)::bigint as n,
             {sig("greatest((sum(o * o / (row_n * column_n)) - 1) * sum(o), 0)")} as chi2,
             count(distinct x) as r, count(distinct y) as c
      from (select x, y, o, sum(o) over (partition by x) as row_n,
                   sum(o) over (partition by y) as column_n
            from (select {a} as x, {b} as y, count(*)::double as o from {source}
                  where {a} is not null and {b} is not null group by 1, 2))"""


def pairs_of(columns):
    return list(combinations(columns, 2))


def auto(numeric, categorical, source: str) -> str:
    binned = {c: f"bin_{c}" for c in numeric}
    level = lambda c: binned.get(c, c)
    parts = []
    for a, b in pairs_of(numeric):
        parts.append(
            f"select left_col, right_col, 'spearman' as method, spearman as value "
            f"from ({spearman(a, b, source)})"
        )
    for a, b in pairs_of([*numeric, *categorical]):
        if b in categorical:
            parts.append(
                f"select '{a}' as left_col, '{b}' as right_col, 'cramers' as method, "
                f"cramers_v as value from ({cramers(level(a), level(b), source)})"
            )
    return union(parts)


def with_bins(numeric, source: str, name: str = "binned") -> str:
    bins = ", ".join(f"{bin_of(c)} as bin_{c}" for c in numeric)
    return f"{name} as materialized (select *, {bins} from {source})"


def alerts() -> str:
    t = ALERT_THRESHOLDS
    stats = union(numeric_stats(c, "feats") for c in ALERT_NUMERIC)
    levels = union(categorical_stats(c, "feats") for c in ALERT_CATEGORICAL)
    missing = union(missing_count(c, "feats") for c in [*ALERT_NUMERIC, *ALERT_CATEGORICAL])

    def check(name: str, source: str, condition: str, value: str) -> str:
        return (
            f"select \"column\", '{name}' as alert, ({value})::double as value "
            f"from {source} where {condition}"
        )

    zero = ratio("zeros", "count + missing")
    unique = "distinct_values = count and count > 1"
    parts = [
        check("constant", "stats", "distinct_values = 1", "distinct_values"),
        check("unique", "stats", unique, "distinct_values"),
        check("zeros", "stats", f"{zero} > {t.zero_share}", zero),
        check("skewed", "stats", f"abs(skewness) > {t.skewness}", "skewness"),
        check("constant", "levels", "distinct_values = 1", "distinct_values"),
        check("unique", "levels", unique, "distinct_values"),
        check("high_cardinality", "levels", f"distinct_values > {t.high_cardinality}", "distinct_values"),
        check("imbalance", "levels", f"imbalance > {t.imbalance}", "imbalance"),
        check("missing", "missing", f"share > {t.missing_share}", "share"),
        f"select concat(left_col, ' x ', right_col) as \"column\", 'high_correlation' as alert, value "
        f"from pairs where abs(value) > {t.correlation}",
    ]
    return f"""
      with {ORDERS}, {with_bins(ALERT_NUMERIC, "feats")},
           stats as ({stats}), levels as ({levels}), missing as ({missing}),
           pairs as ({auto(ALERT_NUMERIC, ALERT_CATEGORICAL, "binned")})
      select "column", alert, {sig("value")} as value from ({union(parts)})"""


# --- feature engineering -------------------------------------------------------------


def category_index(c: str, source: str, where: str = "true") -> str:
    """value and index, most frequent first."""
    return f"""
      select {c} as value, row_number() over (order by count(*) desc, {c}) - 1 as idx,
             count(*) as n from {source} where {c} is not null and {where} group by {c}"""


def index_counts(c: str) -> str:
    return f"""
      select '{c}' as "column", f.{c} as value,
             coalesce(i.idx, (select count(distinct {c}) from feats))::double as idx, count(*) as n
      from feats f left join ({category_index(c, "feats")}) i on f.{c} = i.value
      group by f.{c}, i.idx"""


def slots(c: str, where: str = "true") -> str:
    return f"""
      select f.o_orderkey, '{c}' as "column",
             coalesce(i.idx, (select count(distinct {c}) from feats where {where}))::bigint as slot
      from feats f left join ({category_index(c, "feats", where)}) i on f.{c} = i.value"""


def one_hots(start: int) -> tuple[list[str], str]:
    """Selects of the one-hot elements from place ``start`` on, and the place after them."""
    parts, offset = [], str(start)
    for c in CATEGORICAL:
        parts.append(
            f"select o_orderkey, ({offset} + slot)::bigint as slot, 1.0e0 as value from ({slots(c)})"
        )
        offset += f" + (select count(distinct {c}) + 1 from feats)"
    return parts, offset


def assembled() -> str:
    numbers = [
        f"select o_orderkey, {i}::bigint as slot, {c}::double as value from feats "
        f"where {c} is null or {c} <> 0"
        for i, c in enumerate(NUMERIC)
    ]
    return union([*numbers, *one_hots(len(NUMERIC))[0]])


def prepared() -> str:
    """Imputed numbers, one-hot slots, then missing flags."""
    hots, after = one_hots(len(NUMERIC))
    numbers = [
        f"select o_orderkey, {i}::bigint as slot, "
        f"coalesce({c}::double, avg({c}::double) over ()) as value from feats"
        for i, c in enumerate(NUMERIC)
    ]
    flags = [
        f"select o_orderkey, ({after} + {i})::bigint as slot, 1.0e0 as value from feats "
        f"where {c} is null"
        for i, c in enumerate(NUMERIC)
    ]
    return union([*numbers, *hots, *flags])


def imputed(c: str) -> str:
    return f"""
      select o_orderkey, '{c}' as "column",
             {sig(f"coalesce({c}::double, avg({c}::double) over ())")} as value,
             case when {c} is null then 1.0e0 else 0.0e0 end as missing from feats"""


def parameter(name: str, low: float, high: float, scale: str = "linear") -> str:
    u = f"({h(f"concat_ws(':', '42', '{name}', o_orderkey)")} / 4294967296e0)"
    if scale == "log":
        return f"{sig(f'{low}::double * pow({high / low!r}::double, {u})')} as {name}"
    if scale == "int":
        return f"cast(floor({u} * {high - low + 1}) + {low} as integer) as {name}"
    return f"{sig(f'{low}::double + {high - low!r}::double * {u}')} as {name}"


def added_columns() -> str:
    names = [f"{c}_{end}" for end in ("idx", "ohe") for c in CATEGORICAL]
    names += ["features", "rawPrediction", "probability", "prediction"]
    return union(f"select '{n}' as \"column\", count(*) as rows from orders" for n in names)


DUEL_TEST = f"""
  {SCORED}, test as (select * from scored
                     where {split("event_id", [0.8, 0.2], ["train", "test"])} = 'test'),
  f1s as (select
    (select f1 from ({class_metrics("test")})) as champion_f1,
    (select f1 from ({class_metrics("test", "rival_prediction")})) as challenger_f1)
"""
SUPPLY = "(select l_suppkey, l_quantity, l_returnflag from lineitem)"
WEIGHTS, NAMES = [0.6, 0.2, 0.2], ["train", "validation", "test"]
STATS = ", ".join(f"{sig(c)} as {c}" for c in STAT_DOUBLES)
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ALL_ORDER_COLUMNS = f"o_orderkey, entity_id, ts, {FEATURES}, label"

ORACLE: dict[str, str] = {
    "s1_table_scan": "select * from events",
    "s2_prediction_sink": f"""
      with {SCORED} select event_id, ts, user_id, event_type, value, props, label,
        {sig("p_one")} as p_one, prediction, rival_prediction from scored""",
    "s3_preview": "select * from orders order by o_orderkey limit 10",
    "s5_model_save_load": f"""
      select o_orderkey, true as same_prediction from orders
      where {split("o_orderkey", WEIGHTS, NAMES)} = 'test'""",
    "s6_run_log": f"""
      with {SCORED} {sig_metrics(
          threshold_metrics(),
          "name as run_id, concat('rule_', name) as run_name, 'rules' as parent_run_id,",
      )}""",
    "p1_label_and_prediction": f"with {SCORED} select label, prediction from scored",
    "p2_drop_column": "select * exclude (o_orderpriority) from orders",
    "p3_exclude_columns": "select user_id, event_type, value, props from events",
    "p4_feature_projection": f"with {ORDERS} select {FEATURES} from feats",
    "p5_inputs_and_prediction": f"""
      with {SCORED} select event_id, ts, user_id, event_type, value, props, prediction from scored""",
    "p6_equality_filter": f"""
      with {SCORED} select event_id, label, prediction from scored
      where label = 0 and prediction = 0""",
    "p7_sanitize_identifier": """
      select c_custkey, regexp_replace(split_part(c_name || '.é-' || c_mktsegment || '@example.com',
        '@', 1), '[^a-zA-Z0-9_]', '_', 'g') as identifier from customer""",
    "p8_guarded_ratio": f"""
      select l_suppkey, {ratio(
          "count(*) filter (l_returnflag = 'R' and l_discount = 0)",
          "count(*) filter (l_quantity > 48 and l_discount = 0)",
      )} as ratio from lineitem group by l_suppkey""",
    "j1_pit_lookup": PIT,
    "j1_pit_lookup_hot_keys": PIT,
    "j1_pit_lookup_ties": """
      select o.o_orderkey, o.o_custkey as entity_id, o.o_orderdate as ts, f.last_order, f.last_price
      from orders o asof left join (
        select o_custkey, o_orderdate, max(o_orderkey) as last_order,
               arg_max(o_totalprice, o_orderkey) as last_price
        from orders group by o_custkey, o_orderdate) f
      on o.o_custkey = f.o_custkey and o.o_orderdate >= f.o_orderdate""",
    "j1x_exact_lookup": """
      select e.*, c.c_mktsegment, c.c_acctbal
      from events e left join customer c on e.user_id = c.c_custkey""",
    "j2_training_set": f"""
      with {SCORED},
        facts as (select event_id, user_id, ts, label from scored
                  where event_type in ('purchase', 'signup')),
        clicks as (select user_id, ts, value as last_click from events where event_type = 'click'),
        one as (select f.*, v.last_value, v.last_props from facts f
                asof left join {VIEWS} v on f.user_id = v.user_id and f.ts >= v.ts),
        two as (select f.*, v.last_click from one f
                asof left join clicks v on f.user_id = v.user_id and f.ts >= v.ts)
      select two.*, c.c_mktsegment, c.c_acctbal
      from two left join customer c on two.user_id = c.c_custkey""",
    "j3_late_labels": f"""
      with {SCORED} select s.event_id, s.ts, s.prediction, l.label_ts, l.true_label
      from scored s join {LATE_LABELS} l on s.event_id = l.event_id""",
    "j3_late_label_evaluation": f"""
      with {SCORED}, joined as (select s.prediction, l.true_label
        from scored s join {LATE_LABELS} l on s.event_id = l.event_id)
      {evaluation("joined", "true_label", "prediction")}""",
    "a1_row_count": "select count(*) as rows from lineitem",
    "a1_split_counts": f"""
      select {split("l_orderkey, l_linenumber, l_partkey", WEIGHTS, NAMES)} as split,
             count(*) as rows from lineitem group by 1""",
    "a2_class_metrics": f"with {SCORED} {sig_metrics(class_metrics('scored'))}",
    "a2_class_metrics_by_user": f"""
      with {SCORED} {sig_metrics(class_metrics("scored", by="user_id"), "user_id,")}""",
    "a3_classifier_evaluation": f"with {SCORED} {evaluation('scored', 'label', 'prediction')}",
    "a4_confusion_matrix": f"""
      with {SCORED} select prediction, label, count(*) as rows from scored group by all
      order by prediction, label""",
    "a5_log_loss": f"""
      with {SCORED} select {sig(
          "avg(-ln(greatest(case when label = 1 then p_one else 1 - p_one end, 1e-15)))"
      )} as log_loss from scored""",
    "a6_max_version": "select max(cast(cast(event_id as varchar) as bigint)) as max_version from events",
    "o1_order_by": """
      select o_orderpriority, o_orderstatus, count(*) as rows from orders
      group by all order by o_orderpriority, o_orderstatus""",
    "o3_best_trial": f"""
      with {SCORED}, log as (select *, split_part(name, '_', 2)::integer as trial
                             from ({threshold_metrics()}))
      select trial, {sig("precision")} as precision, {sig("recall")} as recall, {sig("f1")} as f1
      from log order by log.f1 desc, trial limit 1""",
    "u1_union_by_name": f"""
      with {ORDERS}, parts as (
        select *, {split("o_orderkey", [0.5, 0.5], ["0", "1"])} as part from feats)
      select o_orderkey, ts, sum_qty, label from parts
      union all select o_orderkey, ts, sum_qty, label from parts where part = '0'""",
    "r1_hash_split": f"select o_orderkey, {split('o_orderkey', WEIGHTS, NAMES)} as split from orders",
    "r2_two_way_split": f"""
      select event_id, event_type, {split("event_id", [0.8, 0.2], ["train", "test"])} as split
      from events""",
    "f1_category_index": f"with {ORDERS} {union(map(index_counts, CATEGORICAL))}",
    "f2_one_hot": f"with {ORDERS} {union(map(slots, CATEGORICAL))}",
    "f3_assemble": f"with {ORDERS} {assembled()}",
    "f4_unseen_category": f"""
      with {ORDERS} {union(slots(c, "r_name <> 'AFRICA'") for c in CATEGORICAL)}""",
    "f5_missing_numbers": f"with {ORDERS} {union(map(imputed, NUMERIC))}",
    "f6_stage_list": f"""
      with {ORDERS} select slot, count(*) as rows, {sig("sum(value)")} as total
      from ({prepared()}) where value <> 0 group by slot""",
    "t1_validation_rows": f"""
      with {ORDERS} select count(*) as rows, count(*) filter (where label = 0) as rows0, true as learnt
      from feats where {split("o_orderkey", WEIGHTS, NAMES)} = 'validation'""",
    "m1_batch_score_rows": f"""
      with {ORDERS} select o_orderkey, ts, label, true as agrees, true as whole
      from feats where {split("o_orderkey", WEIGHTS, NAMES)} = 'test'""",
    "r1_random_split_parts": "select o_orderkey, 1::bigint as parts from orders",
    "t3_trial_rows": f"""
      select trial::integer as trial, case when trial = 0 then 'seed_parameters_trial'
               else 'optuna_trial_' || lpad(trial::varchar, 3, '0') end as run_name,
             {", ".join(f"{sig(f'case when trial = 0 then {v!r}::double else {k} end')} as {k}"
                        for k, v in SEED_PARAMETERS.items())},
             true as f1_follows, true as none_better, true as learnt
      from (select o_orderkey as trial, {parameter("eta", 0.01, 0.3, "log")},
                   {parameter("max_depth", 3, 12, "int")}, {parameter("min_child_weight", 1.0, 10.0)},
                   {parameter("subsample", 0.5, 1.0)}, {parameter("colsample_bytree", 0.5, 1.0)}
            from (select unnest(range(0, 5)) as o_orderkey))""",
    "t4_refit_rows": f"""
      with {ORDERS} select count(*) as rows, count(*) filter (where label = 0) as rows0, true as learnt
      from feats where {split("o_orderkey", WEIGHTS, NAMES)} = 'test'""",
    "t5_leaderboard_rows": """
      select unnest(['logistic_regression', 'decision_tree', 'random_forest', 'boosted_trees']) as model,
             true as f1_follows, true as in_order, true as exclusion_tells""",
    "t6_importance_rows": f"""
      select unnest({[*NUMERIC, *CATEGORICAL]!r}) as feature, true as in_order, true as whole, true as is_share""",
    "f5_missing_numbers_median": f"""
      with {ORDERS} select o_orderkey, {", ".join(
          f"{sig(f'coalesce({c}::double, (select median({c}::double) from feats))')} as {c}_imp" for c in NUMERIC
      )} from feats""",
    "t2_search_space": f"""
      select o_orderkey as trial, {parameter("eta", 0.01, 0.3, "log")},
             {parameter("max_depth", 3, 12, "int")}, {parameter("min_child_weight", 1.0, 10.0)},
             {parameter("subsample", 0.5, 1.0)}, {parameter("colsample_bytree", 0.5, 1.0)}
      from orders""",
    "m2_added_columns": added_columns(),
    "l1_signature_check": """
      select 'o_orderstatus' as "column", 'missing' as problem, 'string' as expected,
             null::varchar as actual, 0::bigint as rows
      union all select 'o_totalprice', 'type', 'double', 'float', count(o_totalprice) from orders
      union all select 'o_orderdate', 'missing', 'timestamp_ntz', null, 0
      union all select 'status', 'extra', null, 'string', count(o_orderstatus) from orders""",
    "l2_current_aliases": """
      select case event_type when 'purchase' then 'champion' when 'view' then 'challenger'
               else event_type end as alias,
             arg_max(event_id, (ts, event_id)) as version
      from events group by 1""",
    "o2_sample_row": "select * exclude (o_orderpriority) from orders order by o_orderkey limit 1",
    "l3_duel_decision": f"""
      with {DUEL_TEST} select {sig("champion_f1")} as champion_f1,
        {sig("challenger_f1")} as challenger_f1, challenger_f1 > champion_f1 as challenger_wins
      from f1s""",
    "l3_duel_aliases": f"""
      with {DUEL_TEST}
      select 'champion' as alias,
             cast(case when challenger_f1 > champion_f1 then 2 else 1 end as integer) as version from f1s
      union all select 'challenger',
             cast(case when challenger_f1 > champion_f1 then 1 else 2 end as integer) from f1s""",
    "x1_stream_score": f"""
      with {SCORED} select event_id, ts, user_id, event_type, {sig("value")} as value, props, label,
        {sig("p_one")} as p_one, prediction, rival_prediction from scored""",
    "x1_stream_score_model": "select event_id, true as same from events",
    "x1_stream_follows_alias": f"""
      select event_id, cast(case when {split("event_id", [0.5, 0.5], ["early", "late"])} = 'early'
                                 then 1 else 2 end as integer) as model_version, true as same
      from events""",
    "j1_pit_stream": PIT,
    "x2_stream_unanswered": f"""
      with {SCORED} select s.event_id, s.prediction, l.true_label
      from scored s left join {LATE_LABELS} l on s.event_id = l.event_id and s.event_id % 3 <> 0
      where s.event_type = 'purchase'""",
    "x2_stream_late_labels": f"""
      with {SCORED} select s.event_id, s.ts, s.prediction, l.label_ts, l.true_label
      from scored s join {LATE_LABELS} l on s.event_id = l.event_id""",
    "e1_overview": f"""
      with {ORDERS} {overview(
          {"numeric": 11, "categorical": 8, "datetime": 1, "boolean": 0, "other": 0},
          ALL_ORDER_COLUMNS, "feats")}""",
    "e1_overview_duplicates": overview(
        {"numeric": 2, "categorical": 1, "datetime": 0, "boolean": 0, "other": 0},
        "l_suppkey, l_quantity, l_returnflag",
        SUPPLY,
    ),
    "e2_numeric_stats": f"""
      with {ORDERS} select "column", count, missing, distinct_values as distinct, zeros, negatives,
        {STATS} from ({union(numeric_stats(c, "feats") for c in NUMERIC)})""",
    "e3_quantiles": f"with {ORDERS} {quantiles(NUMERIC, 'feats')}",
    "e3_quantiles_sliced": quantiles(LINE_COLUMNS, "lineitem"),
    "e4_histogram": f"with {ORDERS} {union(histogram(c, 'feats') for c in NUMERIC)}",
    "e5_categorical_stats": f"""
      with {ORDERS} select "column", count, distinct_values as distinct, mode, mode_count,
        {sig("imbalance")} as imbalance
      from ({union(categorical_stats(c, "feats") for c in CATEGORICAL)})""",
    "e5_top_values": f"""
      with {ORDERS} select "column", place, value, n, {sig("share")} as share
      from ({union(top_values(c, "feats", 5) for c in CATEGORICAL)})""",
    "e6_text_lengths": union(text_lengths(c, "documents") for c in ("text", "lang", "source")),
    "e7_datetime_stats": """
      select 'ts' as "column", count(ts) as count, count(*) - count(ts) as missing,
             min(ts) as min, max(ts) as max,
             round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) as range_seconds from events""",
    "e8_missing_counts": f"""
      with {ORDERS} {union(missing_count(c, "feats") for c in ALL_ORDER_COLUMNS.split(", "))}""",
    "e8_missing_correlation": f"""
      with {ORDERS}, flags as (select {", ".join(
          f"case when {c} is null{extra} then 1.0e0 else 0.0e0 end as {c}"
          for c in [*NUMERIC, *CATEGORICAL]
          for extra in [{"o_orderstatus": " or o_orderstatus = 'F'", "rflag": " or rflag = 'N'"}.get(c, "")]
      )} from feats)
      {union(
          f"select left_col, right_col, pearson as missing_corr from ({pearson(a, b, 'flags')})"
          for a, b in pairs_of([*NUMERIC, *CATEGORICAL])
      )}""",
    "e9_duplicate_groups": f"""
      select *, count(*) as copies from {SUPPLY} group by all having count(*) > 1""",
    "e9_top_duplicates": f"""
      select *, count(*) as copies from {SUPPLY} group by all having count(*) > 1
      order by copies desc, l_suppkey, l_quantity, l_returnflag limit 10""",
    "e10_alerts": alerts(),
    "e11_interactions": f"""
      with {ORDERS}, {with_bins(NUMERIC, "feats")} {union(
          f"select '{a}' as x_col, '{b}' as y_col, bin_{a} as x_bin, bin_{b} as y_bin, "
          f"count(*) as n from binned where bin_{a} is not null and bin_{b} is not null group by all"
          for a, b in pairs_of(NUMERIC)
      )}""",
    "e12_head_and_tail": """
      (select *, 'head' as part from orders order by o_orderkey limit 10) union all
      (select *, 'tail' as part from orders order by o_orderkey desc limit 10)""",
    "c1_pearson": f"with {ORDERS} {union(pearson(a, b, 'feats') for a, b in pairs_of(NUMERIC))}",
    "c1_pearson_constant": f"""
      with flat_part as (select *, 7.0e0 as flat from part) {union(
          pearson(a, b, "flat_part") for a, b in pairs_of(["p_size", "p_retailprice", "flat"])
      )}""",
    "c2_spearman": f"with {ORDERS} {union(spearman(a, b, 'feats') for a, b in pairs_of(NUMERIC))}",
    "c2_spearman_sliced": union(
        spearman(a, b, "lineitem")
        for a, b in pairs_of(LINE_NUMBERS)
    ),
    "c3_kendall": union(kendall(a, b, "lineitem") for a, b in pairs_of(LINE_NUMBERS)),
    "c3_kendall_binned": f"""
      with cuts as (select {", ".join(
          f"quantile_cont({c}::double, {[k / 16 for k in range(1, 16)]}) as q_{c}" for c in LINE_NUMBERS
      )} from lineitem),
      coded as (select {", ".join(
          f"list_sum(list_transform(list_distinct(q_{c}), lambda q: ({c} > q)::int)) as {c}" for c in LINE_NUMBERS
      )} from lineitem, cuts)
      select *, true as binned from ({union(kendall(a, b, "coded") for a, b in pairs_of(LINE_NUMBERS))})""",
    "c3_kendall_sliced": f"""
      with {ORDERS} {union(kendall(a, b, "feats") for a, b in pairs_of(NUMERIC))}""",
    "c5_cramers_v": f"with {ORDERS} {union(cramers(a, b, 'feats') for a, b in pairs_of(CATEGORICAL))}",
    "c5_cramers_v_corrected": union(
        cramers(a, b, "lineitem", corrected=True)
        for a, b in pairs_of(["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"])
    ),
    "c4_contingency": f"""
      with {ORDERS}, {with_bins(NUMERIC, "feats")} {union(
          contingency(*[f"bin_{c}" if c in NUMERIC else c for c in (a, b)], a, b, "binned")
          for a, b in pairs_of([*NUMERIC, *CATEGORICAL])
      )}""",
    "c6_auto": f"""
      with {ORDERS}, {with_bins(NUMERIC, "feats")}
      {auto(NUMERIC, CATEGORICAL, "binned")}""",
}
