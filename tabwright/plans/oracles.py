"""ANSI SQL for each query of ``queries.py``, written for DuckDB on the same tables."""

from __future__ import annotations


def _md5(seed: int, key: str) -> str:
    return f"md5('{seed}:' || {key}::varchar)"


def _hash01(seed: int, key: str) -> str:
    return f"(('0x' || substr({_md5(seed, key)}, 1, 8))::bigint / 4294967296.0::double)"


def _held_out(prediction: str) -> str:
    """Predictions of the fifth with the smallest keyed hashes, by the rule behind the label."""
    return f"""
        WITH r AS (
          SELECT o_orderkey, substr(o_orderpriority, 1, 1)::int AS p, o_orderstatus = 'O' AS is_open,
                 row_number() OVER (ORDER BY {_md5(42, "o_orderkey")}) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM orders)
        SELECT o_orderkey, {prediction} AS prediction FROM r WHERE is_test"""


GAPPY = """gappy AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 5 THEN l_quantity END AS l_quantity,
         l_extendedprice, CASE WHEN l_discount >= 0.005 THEN l_discount END AS l_discount, l_returnflag
  FROM lineitem)"""

AGED = """aged AS (
  SELECT l_orderkey, l_linenumber, ((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1)::int AS months,
         (l_linestatus = 'F')::int AS sex, l_returnflag, l_discount, l_quantity
  FROM lineitem)"""

BANDS = f"""{AGED}, bands AS (
  SELECT * FROM (VALUES (18, 24, 0, 0), (25, 34, 1, 1), (35, 44, 2, 1), (45, 54, 3, 2), (55, 64, 4, 2),
                        (65, 74, 5, 3), (75, 999, 6, NULL)) AS t(lo, hi, a, b)),
placed AS (
  SELECT aged.*, bands.a, bands.b FROM aged JOIN bands ON months >= lo AND months < hi),
one AS (SELECT a, round(avg((l_returnflag = 'R')::int) * 100, 6) AS rate1 FROM placed GROUP BY a),
two AS (SELECT b, round(avg((l_discount > 0.05)::int) * 100, 6) AS rate2 FROM placed GROUP BY b),
rated AS (
  SELECT lo, hi, rate1, rate2 FROM bands LEFT JOIN one ON bands.a = one.a LEFT JOIN two ON bands.b = two.b)"""

PRIORITY_RATES = """rates AS (
  SELECT o_orderpriority, round(avg((o_orderstatus = 'F')::int) * 100, 6) AS smoke_rate
  FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)"""

JUDGED = """judged AS (
  SELECT (l_returnflag = 'R')::int AS label, (l_discount > 0.05)::int AS by_discount,
         (l_quantity < 25)::int AS by_quantity, (l_extendedprice > 1e9)::int AS never,
         l_extendedprice AS score
  FROM lineitem)"""


def _rule(rule: str, model: str) -> str:
    """Precision, recall and F1 of one rule, as rows."""
    return f"""
  SELECT '{model}' AS model, '{model.split("_")[1]}' AS branch, metric, round(value, 6) AS value FROM (
    WITH c AS (
      SELECT sum(label * {rule})::double AS tp, sum((1 - label) * {rule})::double AS fp,
             sum(label * (1 - {rule}))::double AS fn FROM judged)
    SELECT 'precision' AS metric, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS value FROM c
    UNION ALL SELECT 'recall', CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END FROM c
    UNION ALL SELECT 'f1_score', CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END FROM c)"""


MODELS = f"""{JUDGED}, scores AS ({" UNION ALL ".join([
    _rule("by_discount", "rule_sklearn"), _rule("by_quantity", "rule_scrape"), _rule("never", "rule_spark"),
])})"""


def _profile(cols: list[str], stats: str) -> str:
    """``stats`` with {c} for the column, per column of ``gappy``."""
    return " UNION ALL ".join(f"SELECT '{c}' AS col_name, {stats.format(c=c)} FROM gappy" for c in cols)


def _mode(col: str, table: str) -> str:
    return f"""(SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY 1
               ORDER BY count(*) DESC, {col} LIMIT 1)"""


def _guarded_mean(col: str) -> str:
    """The column, filled with its mean if the missing share is above 0 and below 0.09."""
    share = f"(SELECT 1 - count({col}) / count(*)::double FROM gappy)"
    fill = f"(SELECT avg({col}) FROM gappy)"
    return f"round(CASE WHEN {share} > 0 AND {share} < 0.09 THEN coalesce({col}, {fill}) ELSE {col} END, 6)"


def _target(col: str) -> str:
    mean = f"avg(label) OVER (PARTITION BY {col})"
    return f"round(CASE WHEN {col} IS NOT NULL THEN {mean} END, 6) AS {col}_target"



INVALID = """d AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS l_quantity,
         CASE WHEN l_discount <= 0.08 THEN l_discount END AS l_discount,
         CASE WHEN l_tax >= 0.01 THEN l_tax END AS l_tax
  FROM lineitem)"""

# The last text of an element: entities decoded as the pages use them.
ITEMS = """items AS (
  SELECT page_id, list_transform(
      regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1),
      lambda x: replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&amp;', '&')) AS items
  FROM pages)"""

FIRST_LIST = """l AS (SELECT page_id, regexp_extract(html, '(?s)<ul[^>]*>(.*?)</ul>', 1) AS html FROM pages),
items AS (
  SELECT page_id, list_transform(
      regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1),
      lambda x: replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&amp;', '&')) AS items
  FROM l)"""


def _trimmed(source: str, target: str, col: str) -> str:
    stats = f"(SELECT avg({col}) {{}} 1.6 * stddev_samp({col}) FROM {source})"
    return f"{target} AS (SELECT * FROM {source} WHERE {col} BETWEEN {stats.format('-')} AND {stats.format('+')})"


ORACLES = {
    "table_scan": "SELECT * FROM nation",
    "multi_table_step": """
        WITH buyers AS (SELECT c_mktsegment, count(*) AS n_customers FROM customer
            WHERE c_custkey IN (SELECT o_custkey FROM orders) GROUP BY 1)
        SELECT c_mktsegment, o_orderstatus, n_orders, mean_price, n_customers FROM buyers JOIN (
            SELECT c_mktsegment, o_orderstatus, count(*) AS n_orders, round(avg(o_totalprice), 4) AS mean_price
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) USING (c_mktsegment)""",
    "csv_round_trip": "SELECT * FROM documents",
    "add_null": "SELECT c_custkey, c_name, NULL::INTEGER AS smoke, NULL::DOUBLE AS rate FROM customer",
    "csv_bad_records": """
        SELECT CASE WHEN c_custkey % 11 = 0 THEN 'short' WHEN c_custkey % 13 = 0 THEN 'no number'
                    WHEN c_custkey % 17 = 0 THEN 'long' ELSE 'whole' END AS kind,
            count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS sum_keys,
            CAST(sum(CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 THEN c_nationkey END) AS BIGINT) AS sum_nations
        FROM customer GROUP BY 1""",
    "project_rename": """
        SELECT l_orderkey AS orderkey, l_linenumber AS line, l_quantity AS quantity, l_returnflag AS flag
        FROM lineitem""",
    "require_not_null": f"""
        WITH {GAPPY} SELECT * FROM gappy WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL""",
    "cast_numeric": """
        WITH d AS (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS digits FROM events)
        SELECT event_id, CASE WHEN length(digits) > 1 THEN try_cast(digits AS double) END AS k,
               CASE WHEN event_type <> 'error' THEN value END AS value FROM d""",
    "invalidate_range": f"WITH {INVALID} SELECT * FROM d",
    "drop_sparse_columns": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice >= 2000 THEN l_extendedprice END AS l_extendedprice,
               CASE WHEN l_discount >= 0.005 THEN l_discount END AS l_discount, l_returnflag FROM lineitem""",
    "sigma_trim": """
        WITH s1 AS (SELECT avg(l_quantity) m, stddev_samp(l_quantity) s FROM lineitem),
        t1 AS (SELECT lineitem.* FROM lineitem, s1 WHERE l_quantity BETWEEN m - 1.5 * s AND m + 1.5 * s),
        s2 AS (SELECT avg(l_extendedprice) m, stddev_samp(l_extendedprice) s FROM t1),
        t2 AS (SELECT t1.* FROM t1, s2 WHERE l_extendedprice BETWEEN m - 1.5 * s AND m + 1.5 * s),
        s3 AS (SELECT avg(l_discount) m, stddev_samp(l_discount) s FROM t2)
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount
        FROM t2, s3 WHERE l_discount BETWEEN m - 1.5 * s AND m + 1.5 * s""",
    "missing_profile": "WITH " + GAPPY + _profile(
        ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"],
        " count(*) AS n_rows, count(*) - count({c}) AS n_missing,"
        " round((count(*) - count({c})) / count(*)::double, 6) AS pct_missing"),
    "numeric_profile": "WITH " + GAPPY + _profile(
        ["l_quantity", "l_extendedprice", "l_discount"],
        " count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS sd"),
    "skew_profile": """
        WITH d AS (SELECT value, regexp_extract(props, '([0-9]+)', 1)::double AS k FROM events),
        s AS (SELECT 'value' AS col_name, count(value) AS n, skewness(value) AS g FROM d
              UNION ALL SELECT 'k', count(k), skewness(k) FROM d)
        SELECT col_name, n, round(g, 6) AS skewness, abs(g) > 0.5 AS is_skewed FROM s""",
    "cardinality_profile": f"""
        WITH {GAPPY}, d AS (SELECT * REPLACE (nullif(l_returnflag, 'A') AS l_returnflag) FROM gappy)
        """ + " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, count(DISTINCT {c}) AS n_values,"
        f" count(DISTINCT {c}) + max(({c} IS NULL)::int) AS n_categories FROM d"
        for c in ("l_quantity", "l_discount", "l_linenumber", "l_returnflag")),
    "cardinality_sketch": f"""
        WITH {GAPPY}, d AS (SELECT g.*, l_partkey FROM gappy g JOIN lineitem USING (l_orderkey, l_linenumber))
        """ + " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, count(*) AS n, count(DISTINCT {c}) AS n_values, true AS within_bound FROM d"
        for c in ("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")),
    "impute_mean": f"""
        WITH {GAPPY} SELECT * REPLACE ({_guarded_mean("l_quantity")} AS l_quantity,
                                       {_guarded_mean("l_discount")} AS l_discount) FROM gappy""",
    "impute_mode": f"""
        WITH d AS (SELECT p_partkey, CASE WHEN p_size <= 45 THEN p_size END AS p_size, p_type,
                          nullif(p_brand, 'Brand#7') AS p_brand FROM part)
        SELECT *, coalesce(p_size, {_mode("p_size", "d")}) AS imp_p_size,
               coalesce(p_brand, {_mode("p_brand", "d")}) AS imp_p_brand FROM d""",
    "invalidate_impute": f"""
        WITH {INVALID}
        SELECT *, round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM d)), 6) AS imp_l_quantity,
               coalesce(l_discount, {_mode("l_discount", "d")}) AS imp_l_discount,
               coalesce(l_tax, {_mode("l_tax", "d")}) AS imp_l_tax FROM d""",
    "log_abs": "SELECT c_custkey, round(ln(abs(c_acctbal) + 1), 6) AS log_c_acctbal FROM customer",
    "zscore_log": """
        WITH s AS (SELECT avg(o_totalprice) m, stddev_samp(o_totalprice) s FROM orders)
        SELECT o_orderkey, o_totalprice, round((o_totalprice - m) / s, 6) AS o_totalprice_z,
               round(ln(abs((o_totalprice - m) / s) + 1), 6) AS o_totalprice_z_log FROM orders, s""",
    "log1p_columns": "SELECT o_orderkey, round(ln(o_totalprice + 1), 6) AS o_totalprice FROM orders",
    "target_encode": f"""
        WITH {GAPPY}, d AS (
          SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_returnflag, 'N') AS flag,
                 (l_extendedprice > 40000)::int AS label, coalesce(l_discount > 0.05, false)::int AS cheap,
                 l_linenumber AS line FROM gappy)
        SELECT l_orderkey, l_linenumber, label, cheap, {_target("line")}, {_target("l_quantity")},
               {_target("flag")} FROM d""",
    "feature_matrix": """
        SELECT l_orderkey, l_linenumber, (l_returnflag = 'R')::int AS label, round(l_quantity, 4) AS f0,
               round(l_extendedprice, 4) AS f1, round(l_discount, 4) AS f2 FROM lineitem""",
    "clean_table": f"""
        WITH d AS (
          SELECT o_orderkey, o_orderpriority AS priority, (o_orderstatus = 'F')::int AS target,
                 CASE WHEN o_totalprice <= 480000 THEN o_totalprice END AS price,
                 ((year(o_orderdate) - 1992) * 12 + month(o_orderdate))::double AS months,
                 nullif(c_nationkey, 7) AS nation, CASE WHEN c_acctbal >= -500 THEN c_acctbal END AS balance
          FROM orders JOIN customer ON o_custkey = c_custkey),
        filled AS (
          SELECT o_orderkey, priority, target, months, coalesce(price, (SELECT avg(price) FROM d)) AS price,
                 coalesce(balance, (SELECT avg(balance) FROM d)) AS balance,
                 coalesce(nation, {_mode("nation", "d")}) AS nation FROM d),
        {_trimmed("filled", "t1", "price")}, {_trimmed("t1", "t2", "balance")}, {_trimmed("t2", "t3", "months")}
        SELECT o_orderkey, target, months, round(price, 6) AS price, round(balance, 6) AS balance,
               round(avg(target) OVER (PARTITION BY priority), 6) AS priority_target,
               round(avg(target) OVER (PARTITION BY nation), 6) AS nation_target FROM t3""",
    "split_features": f"""
        WITH r AS (
          SELECT o_orderkey, o_totalprice, CASE WHEN row_number() OVER (ORDER BY {_md5(42, "o_orderkey")})
                 <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS part FROM orders),
        s AS (SELECT avg(o_totalprice) m, stddev_samp(o_totalprice) s FROM r WHERE part = 'train')
        SELECT o_orderkey, o_totalprice, part, round(ln(abs(o_totalprice) + 1), 6) AS log_price,
               round((o_totalprice - m) / s, 6) AS o_totalprice_z,
               round(ln(abs((o_totalprice - m) / s) + 1), 6) AS o_totalprice_z_log FROM r, s""",
    "lookup_join": f"""
        WITH {AGED}, rates AS (
          SELECT sex, months AS age, round(avg((l_returnflag = 'R')::int) * 100, 6) AS smoke_rate
          FROM aged WHERE months <= 75 GROUP BY 1, 2)
        SELECT l_orderkey, l_linenumber, months, aged.sex, smoke_rate
        FROM aged LEFT JOIN rates ON aged.sex = rates.sex AND least(months, 75) = age""",
    "lookup_skewed": """
        WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_linenumber = 7 THEN NULL
                   ELSE l_partkey END AS part FROM lineitem)
        SELECT l.*, p_name, p_size FROM l LEFT JOIN part ON part = p_partkey AND p_size <> 13""",
    "prob_impute": f"""
        WITH {PRIORITY_RATES}
        SELECT o_orderkey, orders.o_orderpriority,
               CASE WHEN smoke_rate IS NULL THEN NULL
                    WHEN smoke_rate <= {_hash01(7, "o_orderkey")} * 100 THEN 0 ELSE 1 END::int AS smoke
        FROM orders LEFT JOIN rates ON orders.o_orderpriority = rates.o_orderpriority""",
    "band_lookup": f"""
        WITH {BANDS}
        SELECT l_orderkey, l_linenumber, months, rate1, rate2,
               round((coalesce(rate1, 0) + coalesce(rate2, 0)) / 2, 6) AS mean_rate
        FROM aged LEFT JOIN rated ON months >= lo AND months < hi""",
    "rate_grid": f"""
        WITH {BANDS}, q AS (
          SELECT avg(l_quantity) FILTER (sex = 1) / avg(l_quantity) FILTER (sex = 0) AS ratio FROM aged),
        grid AS (SELECT s.sex::int AS sex, a.age::int AS age
                 FROM (VALUES (0), (1)) AS s(sex), range(76) AS a(age))
        SELECT sex, age, round((coalesce(rate1, 0) + coalesce(rate2, 0)) / 2
                               * CASE WHEN sex = 0 THEN 1 ELSE ratio END, 6) AS smoke_rate
        FROM grid LEFT JOIN rated ON age >= lo AND age < hi, q""",
    "html_items": f"""
        WITH {ITEMS}
        SELECT page_id, (generate_subscripts(items, 1) - 1)::int AS idx, unnest(items) AS item FROM items""",
    "html_first_list": f"""
        WITH {FIRST_LIST}
        SELECT page_id, (generate_subscripts(items, 1) - 1)::int AS idx, unnest(items) AS item FROM items""",
    "text_slice": f"""
        WITH {FIRST_LIST}, i AS (
          SELECT page_id, (generate_subscripts(items, 1) - 1)::int AS idx, unnest(items) AS t FROM items)
        SELECT page_id, idx,
               CASE idx WHEN 0 THEN substr(t, 1, 3) WHEN 1 THEN substr(t, 2, 3) ELSE substr(t, 1, 2) || '+' END AS key,
               CASE idx WHEN 0 THEN substr(t, 4, 3) WHEN 1 THEN substr(t, 1, 2) ELSE substr(t, 3, 7) END AS value
        FROM i""",
    "html_by_class": """
        WITH t AS (
          SELECT page_id, list_transform(
              regexp_extract_all(html, '(?s)<div class="ad">(.*?)</div>', 1),
              lambda x: replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&amp;', '&')) AS t FROM pages),
        full_ AS (SELECT page_id, list_filter(t, lambda x: x <> '') AS t FROM t)
        SELECT page_id, (generate_subscripts(t, 1) - 1)::int AS idx, unnest(t) AS txt FROM full_""",
    "html_nested_class": "SELECT p_partkey AS page_id, 0 AS idx, p_name AS txt FROM part",
    "html_list_tail": f"""
        WITH {ITEMS}
        SELECT page_id, array_to_string(items[-4:], '|') AS tail, array_to_string(items[2:3], '|') AS middle,
               '' AS "none" FROM items""",
    "html_table_rows": """
        SELECT p_partkey AS page_id, 0 AS idx, 'name' AS key, p_name AS value FROM part
        UNION ALL SELECT p_partkey, 1, 'R&D brand', p_brand FROM part
        UNION ALL SELECT p_partkey, 2, 'size', p_size::varchar FROM part""",
    "predict_ovr": _held_out("CASE WHEN p = 1 THEN 'now' WHEN p IN (2, 3) THEN 'soon' ELSE 'late' END"),
    "predict_final": _held_out("(p IN (1, 2))::int::double"),
    "predict_lr_grid": f"""
        SELECT o_orderkey, (substr(o_orderpriority, 1, 1) IN ('1', '2'))::int::double AS prediction
        FROM orders WHERE {_hash01(43, "o_orderkey")} >= 0.8""",
    "predict_lr": _held_out("(p IN (1, 2))::int::double"),
    "predict_rf": _held_out("(p IN (1, 2) AND is_open)::int::double"),
    "predict_svm": _held_out("((p IN (1, 2)) <> is_open)::int::double"),
    "exact_split": f"""
        SELECT o_orderkey, o_totalprice,
               (row_number() OVER (ORDER BY {_md5(42, "o_orderkey")}) <= ceil(0.2 * count(*) OVER ()))::int AS is_test
        FROM orders""",
    "hash_split": f"""
        SELECT o_orderkey, CASE WHEN {_hash01(42, "o_orderkey")} < 0.8 THEN 'train' ELSE 'test' END AS part
        FROM orders""",
    "stratified_folds": f"""
        SELECT o_orderkey, o_orderstatus,
               (ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY {_md5(42, "o_orderkey")}) - 1)::int AS fold
        FROM orders""",
    "binary_metrics": f"""
        WITH {JUDGED}, c AS (
          SELECT sum(label * by_discount)::double AS tp, sum(by_discount)::double AS said, sum(label)::double AS pos
          FROM judged)
        SELECT round(tp / said, 6) AS precision, round(tp / pos, 6) AS recall,
               round(2 * tp / (said + pos), 6) AS f1_score FROM c""",
    "weighted_metrics": f"""
        WITH {JUDGED}, c AS (
          SELECT k, sum((label = k AND by_discount = k)::int)::double AS tp, sum((by_discount = k)::int)::double AS said,
                 sum((label = k)::int)::double AS pos FROM judged, (VALUES (0), (1)) AS v(k) GROUP BY k)
        SELECT round(sum(pos * tp / said) / sum(pos), 6) AS precision, round(sum(tp) / sum(pos), 6) AS recall,
               round(sum(pos * 2 * tp / (said + pos)) / sum(pos), 6) AS f1_score FROM c""",
    "roc_auc": f"""
        WITH {JUDGED}, r AS (
          SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::double AS rank
          FROM judged),
        c AS (SELECT sum(label)::double AS pos, sum(1 - label)::double AS neg, sum(label * rank) AS ranks FROM r)
        SELECT round((ranks - pos * (pos + 1) / 2) / (pos * neg), 6) AS auc FROM c""",
    "fold_accuracy": f"""
        WITH d AS (
          SELECT floor({_hash01(42, "o_orderkey")} * 5)::int AS fold,
                 ((o_orderstatus = 'F') = (o_totalprice > 200000))::int AS hit FROM orders),
        f AS (SELECT fold, count(*) AS n, avg(hit) AS accuracy FROM d GROUP BY fold)
        SELECT fold, n, round(accuracy, 6) AS accuracy, round(avg(accuracy) OVER (), 6) AS mean_accuracy FROM f""",
    "metrics_long": f"WITH {MODELS} SELECT * FROM scores",
    "metrics_store": f"""
        WITH {MODELS}, stored AS (
            SELECT model, branch, metric, CASE WHEN model = 'rule_scrape' THEN 0.0::double ELSE value END AS value
            FROM scores WHERE model IN ('rule_sklearn', 'rule_scrape'))
        SELECT *, (SELECT model FROM stored WHERE metric = 'f1_score'
            ORDER BY value DESC, CASE model WHEN 'rule_sklearn' THEN 1 ELSE 2 END LIMIT 1) AS best FROM stored""",
    "best_model": f"""
        WITH {MODELS}
        SELECT model, branch, value FROM scores WHERE metric = 'f1_score'
        ORDER BY value DESC, CASE model WHEN 'rule_sklearn' THEN 1 WHEN 'rule_scrape' THEN 2 ELSE 3 END LIMIT 1""",
}
