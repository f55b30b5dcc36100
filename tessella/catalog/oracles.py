"""DuckDB SQL for the queries: an independent statement of each result.

Every string is a chain of common table expressions over the registered
tables, built from the blocks below. Fitted models have no entry here.
"""

from __future__ import annotations

# Fixed values, stated here again so that the SQL stands on its own.
FEATURES = (
    "credit_score",
    "age",
    "tenure",
    "balance",
    "products_number",
    "credit_card",
    "active_member",
    "estimated_salary",
    "country_index",
    "gender_index",
)
NUMERIC = FEATURES[:8]
COLUMNS = (
    "customer_id, credit_score, country, gender, age, tenure, balance, products_number,"
    " credit_card, active_member, estimated_salary, churn"
)
NAMES = [c.strip() for c in COLUMNS.split(",")]
NUMBERS = [c for c in NAMES if c not in ("country", "gender")]
K, MAX_K, ROUNDS = 4, 10, 5


def _each(template: str, sep: str = ", ", items=FEATURES) -> str:
    return sep.join(template.format(f=f) for f in items)


def _with(*blocks: str) -> str:
    return "WITH " + ",\n".join(blocks) + "\n"


# The customer table -----------------------------------------------------------

CUSTOMERS = """
today AS (SELECT max(o_orderdate) AS d FROM orders),
history AS (
  SELECT o_custkey, count(*) AS n, min(o_orderdate) AS f, max(o_orderdate) AS l,
         max(o_totalprice) AS maxp, count(DISTINCT o_orderpriority) AS np,
         max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urg,
         sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS nf
  FROM orders GROUP BY o_custkey),
customers AS (
  SELECT c_custkey AS customer_id,
         CAST(350 + floor(500 * CAST(nf AS DOUBLE) / n) AS INTEGER) AS credit_score,
         r_name AS country,
         c_mktsegment AS gender,
         CAST(n AS INTEGER) AS age,
         CAST(floor(datediff('day', f, d) / 365) AS INTEGER) AS tenure,
         c_acctbal AS balance,
         CAST(np AS INTEGER) AS products_number,
         CAST(urg AS INTEGER) AS credit_card,
         CAST(CASE WHEN datediff('day', l, d) <= 365 THEN 1 ELSE 0 END AS INTEGER) AS active_member,
         maxp AS estimated_salary,
         CAST(CASE WHEN l IS NULL OR datediff('day', l, d) > 180 THEN 1 ELSE 0 END AS INTEGER)
           AS churn
  FROM customer
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN history ON o_custkey = c_custkey
  CROSS JOIN today)"""

DIRTY = """
dirty AS (
  SELECT customer_id, credit_score,
         CASE WHEN customer_id % 23 <> 0 THEN country END AS country,
         gender,
         CASE WHEN customer_id % 29 <> 0 THEN age END AS age,
         tenure,
         CASE WHEN customer_id % 17 <> 0 THEN balance END AS balance,
         products_number, credit_card, active_member, estimated_salary, churn
  FROM customers)"""


def _encoded(source: str) -> str:
    labels = ",".join(
        f"""
{c}_labels AS (
  SELECT {c} AS label, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS position
  FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})"""
        for c in ("country", "gender")
    )
    return f"""{labels},
encoded AS (
  SELECT s.*,
         CAST(coalesce(a.position, (SELECT count(*) FROM country_labels)) AS DOUBLE)
           AS country_index,
         CAST(coalesce(b.position, (SELECT count(*) FROM gender_labels)) AS DOUBLE)
           AS gender_index
  FROM {source} s
  LEFT JOIN country_labels a ON a.label = s.country
  LEFT JOIN gender_labels b ON b.label = s.gender)"""


COMPLETE = f"""
complete AS (SELECT * FROM encoded WHERE {_each("{f} IS NOT NULL", " AND ", NUMERIC)})"""

SCALED = f"""
moments AS (
  SELECT {_each("avg(CAST({f} AS DOUBLE)) AS m_{f}, stddev_samp(CAST({f} AS DOUBLE)) AS s_{f}")}
  FROM complete),
scaled AS (
  SELECT customer_id,
         {_each("CASE WHEN s_{f} > 0 THEN ({f} - m_{f}) / s_{f} ELSE 0 END AS {f}")}
  FROM complete CROSS JOIN moments)"""

FEATURE_TABLE = (CUSTOMERS, _encoded("customers"), COMPLETE, SCALED)


# Clustering with declared centres ---------------------------------------------

DISTANCE = _each("(x.{f} - c.{f}) * (x.{f} - c.{f})", " + ")


def _nearest(centres: str, name: str) -> str:
    """Nearest centre of every customer, the lowest number on a tie."""
    return f"""
{name} AS (
  SELECT customer_id, cluster FROM (
    SELECT x.customer_id, c.cluster,
           row_number() OVER (PARTITION BY x.customer_id ORDER BY {DISTANCE}, c.cluster) AS place
    FROM scaled x CROSS JOIN {centres} c)
  WHERE place = 1)"""


SEEDS = f"""
seeds AS (
  SELECT CAST(customer_id AS INTEGER) AS cluster, {_each("{f}")}
  FROM scaled WHERE customer_id < {K})"""
LABELS = SEEDS + "," + _nearest("seeds", "labels")
LABELLED = """
labelled AS (SELECT complete.*, labels.cluster FROM complete JOIN labels USING (customer_id))"""
LABELLED_TABLE = (*FEATURE_TABLE, LABELS, LABELLED)

SEEDED_LABELS = f"""
distances AS (
  SELECT x.customer_id, CAST(c.customer_id AS INTEGER) AS cluster, {DISTANCE} AS distance
  FROM scaled x JOIN scaled c ON c.customer_id < {MAX_K}),
grouped AS (
  SELECT customer_id, k, cluster FROM (
    SELECT customer_id, CAST(k AS INTEGER) AS k, cluster,
           row_number() OVER (PARTITION BY customer_id, k ORDER BY distance, cluster) AS place
    FROM distances JOIN range(2, {MAX_K} + 1) r(k) ON cluster < k)
  WHERE place = 1)"""

# Needs grouped(customer_id, k, cluster): any number of labellings side by side.
SILHOUETTES = f"""
points AS (
  SELECT g.k, g.cluster, x.*, {_each("x.{f} * x.{f}", " + ")} AS norm
  FROM grouped g JOIN scaled x USING (customer_id)),
clusters AS (
  SELECT k, cluster, count(*) AS n, sum(norm) AS psi, {_each("sum({f}) AS {f}")}
  FROM points GROUP BY k, cluster),
spread AS (
  SELECT x.k, x.customer_id, x.cluster = c.cluster AS own, c.n,
         x.norm + c.psi / c.n - 2 * ({_each("x.{f} * c.{f}", " + ")}) / c.n AS distance
  FROM points x JOIN clusters c ON x.k = c.k),
sides AS (
  SELECT k, customer_id,
         max(CASE WHEN own THEN n END) AS n,
         max(CASE WHEN own AND n > 1 THEN distance * n / (n - 1) END) AS a,
         min(CASE WHEN NOT own THEN distance END) AS b
  FROM spread GROUP BY k, customer_id),
scores AS (
  SELECT k, avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1
                     ELSE 0 END) AS silhouette_score
  FROM sides GROUP BY k)"""

SCORE_TABLE = (*FEATURE_TABLE, SEEDED_LABELS, SILHOUETTES)
BEST = "(SELECT k FROM scores ORDER BY silhouette_score DESC, k LIMIT 1)"
BAND = (
    "CASE WHEN silhouette_score > 0.5 THEN 'strong' WHEN silhouette_score >= 0.25 THEN 'moderate'"
    " ELSE 'weak' END"
)


def _lloyd() -> str:
    """Rounds of assigning and averaging, unrolled."""
    blocks = [SEEDS, "at_0 AS (SELECT * FROM seeds)"]
    for i in range(ROUNDS):
        blocks.append(_nearest(f"at_{i}", f"round_{i}"))
        blocks.append(
            f"""
means_{i} AS (
  SELECT r.cluster, {_each("avg(x.{f}) AS {f}")}
  FROM round_{i} r JOIN scaled x USING (customer_id) GROUP BY r.cluster),
at_{i + 1} AS (
  SELECT c.cluster, {_each("coalesce(m.{f}, c.{f}) AS {f}")}
  FROM at_{i} c LEFT JOIN means_{i} m ON m.cluster = c.cluster)"""
        )
    return ",".join(blocks)


# Profiles ---------------------------------------------------------------------

# Names and thresholds of the segment rules, and the profile columns.
PROFILES = """
profiles AS (
  SELECT cluster, count(*) AS size,
         avg(credit_score) AS avg_credit_score, avg(age) AS avg_age, avg(tenure) AS avg_tenure,
         avg(balance) AS avg_balance, avg(products_number) AS avg_products,
         avg(estimated_salary) AS avg_salary, avg(credit_card) AS pct_credit_card,
         avg(active_member) AS pct_active, avg(country_index) AS country_mode,
         avg(gender_index) AS gender_mode
  FROM labelled GROUP BY cluster)"""
NAMED = """
medians AS (
  SELECT median(avg_balance) AS median_avg_balance, median(avg_salary) AS median_avg_salary,
         median(avg_products) AS median_avg_products
  FROM profiles),
named AS (
  SELECT profiles.*,
         CASE WHEN avg_balance > median_avg_balance AND avg_salary > median_avg_salary
                THEN 'High-Value Customers'
              WHEN avg_age < 35 AND avg_tenure < 3 THEN 'Young Newcomers'
              WHEN pct_active < 0.5 THEN 'Inactive/At-Risk'
              WHEN avg_products > median_avg_products THEN 'Multi-Product Engagers'
              WHEN avg_balance < median_avg_balance THEN 'Low-Balance Savers'
              ELSE 'Standard Segment ' || cluster END AS segment_name,
         size / sum(size) OVER () * 100 AS share_percent
  FROM profiles CROSS JOIN medians)"""
PROFILE_TABLE = (*LABELLED_TABLE, PROFILES)
NAMED_TABLE = (*PROFILE_TABLE, NAMED)
CHURN = """
churned AS (
  SELECT cluster, count(*) AS total_customers, avg(churn) AS churn_rate
  FROM labelled GROUP BY cluster)"""
CHURN_TABLE = (*LABELLED_TABLE, CHURN)

PROFILE_COLUMNS = (
    "cluster, size, avg_credit_score, avg_age, avg_tenure, round(avg_balance, 6) AS avg_balance,"
    " avg_products, round(avg_salary, 6) AS avg_salary, pct_credit_card, pct_active,"
    " country_mode, gender_mode"
)
LABELLED_COLUMNS = COLUMNS.replace("customer_id,", "customer_id, cluster,", 1)
ROUNDED_SCORE = "round(silhouette_score, 6) + 0.0 AS silhouette_score"


def _types() -> str:
    fixed = {"customer_id": "bigint", "country": "string", "gender": "string"}
    doubles = ("balance", "estimated_salary")
    rows = [
        f"({i}, '{c}', '{fixed.get(c, 'double' if c in doubles else 'int')}')"
        for i, c in enumerate(NAMES, start=1)
    ]
    return ", ".join(rows)


def _long(source: str, value: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT customer_id, '{f}' AS feature, {value.format(f=f)} AS value FROM {source}"
        for f in FEATURES
    )


def _per_column(source: str, template: str) -> str:
    return "\nUNION ALL ".join(template.format(c=c, source=source) for c in NAMES)


SUMMARY = (
    "SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,"
    " round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min,"
    " CAST(max({c}) AS DOUBLE) AS max FROM {source}"
)
MISSING = (
    "SELECT '{c}' AS column_name, count(*) - count({c}) AS missing,"
    " round((count(*) - count({c})) / count(*) * 100, 2) AS missing_percent FROM {source}"
)


BY_COUNTRY = """SELECT customer_id, min(customer_id) OVER (PARTITION BY country) AS first_member,
       count(*) OVER (PARTITION BY country) AS size FROM customers"""

# One cluster for each country, numbered by size, then by the label's index: most
# frequent first, ties by name.
NUMBERED = """
countries AS (
  SELECT country, CAST(row_number() OVER (ORDER BY count(*) DESC, country) - 1 AS INTEGER) AS cluster
  FROM customers {where} GROUP BY country)"""
LABELLED_BY_COUNTRY = """
labelled AS (SELECT customers.*, cluster, 0 AS country_index, 0 AS gender_index FROM customers JOIN countries USING (country))"""
BY_COUNTRY_TABLE = (CUSTOMERS, NUMBERED.format(where=""), LABELLED_BY_COUNTRY)
REPORT = """SELECT cluster, segment_name, size, share_percent, {means}, pct_credit_card * 100 AS credit_card_percent,
       pct_active * 100 AS active_percent
FROM named ORDER BY cluster"""
PROFILE_AVERAGES = ("avg_credit_score", "avg_age", "avg_tenure", "avg_balance", "avg_products", "avg_salary")
# Pairs of customers that two labellings put together or apart alike.
AGREEMENT = """
paired AS (SELECT cluster AS a, CAST(customer_id % 4 AS INTEGER) AS b, count(*) AS n FROM labelled GROUP BY ALL),
agreed AS (
  SELECT (SELECT sum(n) FROM paired) AS n,
         (SELECT sum(n * (n - 1) / 2) FROM paired) AS in_both,
         (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM paired GROUP BY a)) AS one,
         (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM paired GROUP BY b)) AS two)"""
GRID = """
bounds AS (SELECT min(balance) AS least, (max(balance) - min(balance)) / 20 AS width FROM labelled),
gridded AS (
  SELECT CAST(least(floor((balance - least) / width), 19) AS INTEGER) AS x_bin, products_number AS y, cluster,
         count(*) AS n
  FROM labelled CROSS JOIN bounds GROUP BY ALL)"""

ORACLES: dict[str, str] = {
    "sink_by_segment": _with(*LABELLED_TABLE) + f"SELECT {LABELLED_COLUMNS} FROM labelled WHERE cluster = {K - 1}",
    "rejected_counts": _with(CUSTOMERS)
    + """SELECT CASE WHEN customer_id % 19 = 0 THEN 'age is no int' WHEN customer_id % 23 = 0 THEN 'too few fields'
            ELSE 'too many fields' END AS reason, count(*) AS n
FROM customers WHERE customer_id % 19 = 0 OR customer_id % 23 = 0 OR customer_id % 29 = 0 GROUP BY ALL""",
    "accepted_lines": _with(CUSTOMERS)
    + f"SELECT {COLUMNS} FROM customers WHERE customer_id % 19 != 0 AND customer_id % 23 != 0 AND customer_id % 29 != 0",
    "final_by_country": _with(*BY_COUNTRY_TABLE) + f"SELECT {LABELLED_COLUMNS} FROM labelled",
    "segmentation_by_country": _with(*BY_COUNTRY_TABLE, PROFILES, NAMED)
    + REPORT.format(means=", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in PROFILE_AVERAGES)),
    "scored_by_bundle": _with(CUSTOMERS, NUMBERED.format(where="WHERE customer_id % 2 = 0"))
    + """SELECT customer_id, country, cluster, 'Standard Segment ' || cluster AS segment_name
FROM customers JOIN countries USING (country)""",
    "clustering_agreement": _with(*LABELLED_TABLE, AGREEMENT)
    + """SELECT CAST(n AS BIGINT) AS n,
       round((n * (n - 1) / 2 + 2 * in_both - one - two) / (n * (n - 1) / 2), 6) AS rand_index,
       round((in_both - one * two / (n * (n - 1) / 2)) / ((one + two) / 2 - one * two / (n * (n - 1) / 2)), 6) + 0.0
         AS adjusted_rand_index
FROM agreed""",
    "matched_labels": _with(CUSTOMERS) + "SELECT country, count(*) AS n FROM customers GROUP BY country",
    "segment_grid": _with(*LABELLED_TABLE, GRID)
    + """SELECT x_bin, round(least + x_bin * width, 6) AS x_from, round(least + (x_bin + 1) * width, 6) AS x_to,
       y, cluster, n FROM gridded CROSS JOIN bounds""",
    "scan_csv": _with(CUSTOMERS) + f"SELECT {COLUMNS} FROM customers",
    "scan_csv_inferred": _with(CUSTOMERS)
    + "SELECT * REPLACE (CAST(customer_id AS INTEGER) AS customer_id) FROM customers",
    "row_count": _with(CUSTOMERS) + "SELECT count(*) AS n_rows FROM customers",
    "schema_report": _with(CUSTOMERS)
    + f"""SELECT position, column_name, type, 12 AS n_columns,
       (SELECT count(*) FROM customers) AS n_rows
FROM (VALUES {_types()}) t(position, column_name, type)""",
    "head_records": _with(CUSTOMERS)
    + f"SELECT {COLUMNS} FROM customers ORDER BY customer_id LIMIT 5",
    "describe_numeric": _with(CUSTOMERS)
    + "\nUNION ALL ".join(SUMMARY.format(c=c, source="customers") for c in NUMBERS),
    "describe_strings": _with(CUSTOMERS, DIRTY)
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, min({c}) AS min, max({c}) AS max"
        " FROM dirty"
        for c in ("country", "gender")
    ),
    "non_null_counts": _with(CUSTOMERS, DIRTY)
    + "SELECT "
    + ", ".join(f"count({c}) AS {c}" for c in NAMES)
    + " FROM dirty",
    "missing_values": _with(CUSTOMERS, DIRTY) + _per_column("dirty", MISSING),
    "missing_columns": _with(CUSTOMERS, DIRTY)
    + f"SELECT * FROM ({_per_column('dirty', MISSING)}) WHERE missing > 0",
    "index_country": _with(CUSTOMERS, DIRTY, _encoded("dirty"))
    + "SELECT customer_id, country, country_index FROM encoded",
    "index_gender": _with(CUSTOMERS, DIRTY, _encoded("dirty"))
    + "SELECT customer_id, gender, gender_index FROM encoded",
    "feature_projection": _with(CUSTOMERS, _encoded("customers"))
    + f"SELECT customer_id, {_each('{f}')} FROM encoded",
    "assemble_features": _with(CUSTOMERS, DIRTY, _encoded("dirty"), COMPLETE)
    + _long("complete", "CAST({f} AS DOUBLE)"),
    "standardize_features": _with(*FEATURE_TABLE) + _long("scaled", "round({f}, 6) + 0.0"),
    "feature_pipeline": _with(*FEATURE_TABLE)
    + f"SELECT customer_id, {_each('round({f}, 6) + 0.0 AS {f}')} FROM scaled",
    "assign_clusters": _with(*LABELLED_TABLE) + "SELECT customer_id, cluster FROM labelled",
    "kmeans_lloyd_step": _with(*FEATURE_TABLE, _lloyd())
    + "\nUNION ALL ".join(
        f"SELECT cluster, '{f}' AS feature, round({f}, 6) + 0.0 AS centre FROM at_{ROUNDS}"
        for f in FEATURES
    ),
    "silhouette_score": _with(
        *FEATURE_TABLE,
        LABELS,
        f"grouped AS (SELECT customer_id, {K} AS k, cluster FROM labels)",
        SILHOUETTES,
    )
    + f"SELECT k, {ROUNDED_SCORE} FROM scores",
    "cluster_sizes": _with(*LABELLED_TABLE)
    + "SELECT cluster, count(*) AS size FROM labelled GROUP BY cluster ORDER BY cluster",
    "sizes_by_k": _with(*FEATURE_TABLE, SEEDED_LABELS)
    + "SELECT k, cluster, count(*) AS size FROM grouped GROUP BY k, cluster ORDER BY k, cluster",
    "best_k": _with(*SCORE_TABLE) + f"SELECT k, {ROUNDED_SCORE} FROM scores WHERE k = {BEST}",
    "silhouette_series": _with(*SCORE_TABLE)
    + f"SELECT k, {ROUNDED_SCORE}, {BAND} AS band, k = {BEST} AS is_best FROM scores ORDER BY k",
    "silhouette_band": _with(*SCORE_TABLE) + f"SELECT k, {BAND} AS band FROM scores ORDER BY k",
    "compare_rule": _with(
        *FEATURE_TABLE,
        LABELS,
        f"""
grouped AS (
  SELECT customer_id, 1 AS k, cluster FROM labels
  UNION ALL SELECT customer_id, 2, CAST(customer_id % {K} AS INTEGER) FROM scaled)""",
        SILHOUETTES,
    )
    + """SELECT round(a, 6) + 0.0 AS kmeans, round(b, 6) + 0.0 AS bisecting_kmeans,
       CASE WHEN a > b THEN 'kmeans' ELSE 'bisecting_kmeans' END AS winner,
       round(abs(a - b), 6) AS delta
FROM (SELECT max(CASE WHEN k = 1 THEN silhouette_score END) AS a,
             max(CASE WHEN k = 2 THEN silhouette_score END) AS b FROM scores)""",
    "cluster_profiles": _with(*PROFILE_TABLE)
    + f"SELECT {PROFILE_COLUMNS} FROM profiles ORDER BY cluster",
    "profile_lookup": _with(*PROFILE_TABLE)
    + f"SELECT {PROFILE_COLUMNS} FROM profiles WHERE cluster = {K - 1}",
    "segment_share": _with(*NAMED_TABLE)
    + "SELECT cluster, size, share_percent FROM named ORDER BY cluster",
    "profile_medians": _with(*NAMED_TABLE)
    + """SELECT round(median_avg_balance, 6) AS median_avg_balance,
       round(median_avg_salary, 6) AS median_avg_salary,
       round(median_avg_products, 6) AS median_avg_products FROM medians""",
    "segment_names": _with(*NAMED_TABLE)
    + "SELECT cluster, segment_name FROM named ORDER BY cluster",
    "segment_report": _with(*NAMED_TABLE)
    + """SELECT cluster, segment_name, size, share_percent, avg_credit_score, avg_age, avg_tenure,
       round(avg_balance, 6) AS avg_balance, avg_products, round(avg_salary, 6) AS avg_salary,
       pct_credit_card * 100 AS credit_card_percent, pct_active * 100 AS active_percent
FROM named ORDER BY cluster""",
    "churn_by_cluster": _with(*CHURN_TABLE) + "SELECT * FROM churned ORDER BY cluster",
    "churn_percent": _with(*CHURN_TABLE)
    + """SELECT cluster, churn_rate * 100 AS churn_percent,
       printf('%.1f%%', churn_rate * 100) AS label FROM churned ORDER BY cluster""",
    "clustered_customers": _with(*LABELLED_TABLE) + f"SELECT {LABELLED_COLUMNS} FROM labelled",
    "segment_projection": _with(*LABELLED_TABLE)
    + """SELECT customer_id, balance / 1000 AS balance_thousands, products_number, cluster
FROM labelled""",
    "sink_evaluation": _with(*SCORE_TABLE) + f"SELECT k, {ROUNDED_SCORE} FROM scores",
    "sink_profiles": _with(*PROFILE_TABLE) + f"SELECT {PROFILE_COLUMNS} FROM profiles",
    "sink_churn": _with(*CHURN_TABLE) + "SELECT * FROM churned",
    "sink_clustered": _with(*LABELLED_TABLE) + f"SELECT {LABELLED_COLUMNS} FROM labelled",
    "sink_clustered_csv": _with(*LABELLED_TABLE) + f"SELECT {LABELLED_COLUMNS} FROM labelled",
    "standardize_dirty": _with(CUSTOMERS, DIRTY, _encoded("dirty"), COMPLETE, SCALED)
    + _long("scaled", "round({f}, 6) + 0.0"),
    "left_out": _with(CUSTOMERS, DIRTY)
    + "SELECT (count(*) - count_if(bad))::BIGINT AS clustered, count_if(bad)::BIGINT AS left_out FROM (SELECT "
    + " OR ".join(f"{c} IS NULL" for c in NUMERIC)
    + " AS bad FROM dirty)",
    "kmeans_by_country": _with(CUSTOMERS) + BY_COUNTRY,
    "bisecting_by_country": _with(CUSTOMERS) + BY_COUNTRY,
    # Each customer lies on its cluster's centre: the best possible score, first reached
    # with as many clusters as there are countries; the tie goes to Bisecting K-Means.
    "sweep_by_country": _with(CUSTOMERS)
    + "SELECT count(DISTINCT country)::INTEGER AS k, 1.0::DOUBLE AS silhouette_score FROM customers",
    "compare_by_country": """SELECT 1.0::DOUBLE AS kmeans, 1.0::DOUBLE AS bisecting_kmeans,
       'bisecting_kmeans' AS winner, 0.0::DOUBLE AS delta""",
}
