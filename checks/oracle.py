"""SQL equivalents of the registered queries, written independently of the library."""

from __future__ import annotations

from checks.binding import TABLES

BINDING = """
sales AS (
  SELECT CAST(o_orderdate AS DATE) AS t_dat, o_custkey AS customer_id, l_partkey AS article_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS sales_channel_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), articles AS (
  SELECT p_partkey AS article_id, p_name AS prod_name,
         split_part(p_name, ' ', 1) AS colour_group_name,
         split_part(p_name, ' ', 2) AS graphical_appearance_name,
         split_part(p_name, ' ', 2) AS product_type_name,
         lower(p_type) AS index_group_name, lower(p_type) AS index_name,
         nullif(p_brand, 'Brand#4') AS department_name, p_brand AS section_name,
         CAST(p_size % 5 AS VARCHAR) AS garment_group_name,
         split_part(p_name, ' ', 2) AS product_group_name,
         nullif(split_part(p_name, ' ', 1), 'cold') AS perceived_colour_value_name,
         split_part(p_name, ' ', 1) AS perceived_colour_master_name,
         p_brand AS detail_desc
  FROM part
), customers AS (
  SELECT c_custkey AS customer_id, CAST(c_nationkey AS VARCHAR) AS postal_code,
         CAST(floor((c_acctbal + 1000) / 150) AS INT) AS age,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'ACTIVE' WHEN 'MACHINERY' THEN 'PRE-CREATE'
              ELSE 'LEFT CLUB' END AS club_member_status,
         CASE c_nationkey % 3 WHEN 0 THEN ' Regularly ' WHEN 1 THEN 'Monthly' ELSE 'NONE' END
              AS fashion_news_frequency
  FROM customer
)"""

CHANNEL = "CASE sales_channel_id WHEN 1 THEN 'Store' WHEN 2 THEN 'Online' ELSE 'Channel ' || sales_channel_id END"


def _title(column: str) -> str:
    return f"upper(left({column}, 1)) || lower(substr({column}, 2))"


def _pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} <> 0 THEN CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100 ELSE 0 END"


def _growth(current: str, previous: str) -> str:
    return (f"round(CASE WHEN {previous} <> 0 THEN CAST({current} - {previous} AS DOUBLE)"
            f" / CAST({previous} AS DOUBLE) * 100 END, 6)")


def _weekly(year: str) -> str:
    return f"""
  SELECT year, week, transactions_count, prev_week_transactions, prev_year_transactions,
         {_growth('transactions_count', 'prev_week_transactions')} AS wow_change_pct,
         {_growth('transactions_count', 'prev_year_transactions')} AS yoy_change_pct
  FROM (SELECT *, lag(transactions_count) OVER (ORDER BY year, week) AS prev_week_transactions,
               lag(transactions_count) OVER (PARTITION BY week ORDER BY year) AS prev_year_transactions
        FROM (SELECT CAST({year} AS INT) AS year, CAST(weekofyear(t_dat) AS INT) AS week,
                     count(*) AS transactions_count
              FROM sales GROUP BY ALL))"""


def _article_counts(attribute: str, condition: str) -> str:
    return (f"SELECT {attribute}, count(*) AS sales_count FROM sales JOIN articles USING (article_id)"
            f" WHERE {condition} GROUP BY {attribute}")


def _gaps(purchases: str) -> str:
    return f"""
  SELECT CAST(date_diff('day', first_day, second_day) AS INT) AS days_between, count(*) AS customers_count
  FROM (SELECT min(t_dat) AS first_day, max(t_dat) AS second_day
        FROM (SELECT customer_id, t_dat, row_number() OVER (PARTITION BY customer_id ORDER BY t_dat) AS rn
              FROM {purchases})
        WHERE rn <= 2 GROUP BY customer_id HAVING count(*) = 2)
  GROUP BY days_between"""


GAP_BUCKETS = f"""
  SELECT bucket_label, CAST(coalesce(sum(customers_count), 0) AS BIGINT) AS customers_count,
         round({_pct('coalesce(sum(customers_count), 0)', 'sum(sum(customers_count)) OVER ()')}, 6)
           AS customers_share_pct
  FROM (VALUES (0, 0, '0 days (same day)'), (1, 7, '1-7 days'), (8, 30, '8-30 days'), (31, 90, '31-90 days'),
               (91, 180, '91-180 days'), (181, 365, '181-365 days'), (366, 99999999, '366+ days'))
       AS b(lo, hi, bucket_label)
  LEFT JOIN src ON days_between BETWEEN lo AND hi GROUP BY bucket_label"""

QUESTIONS = {
    "q01": """
  SELECT lo || '-' || (lo + 4) AS age_group, count(*) AS customer_count
  FROM (SELECT CAST(floor(age / 5) * 5 AS INT) AS lo FROM customers
        WHERE age IS NOT NULL AND lower(club_member_status) = 'active')
  GROUP BY lo""",
    "q02": """
  SELECT f AS fashion_news_frequency, avg(n) AS avg_purchases_per_customer
  FROM (SELECT upper(trim(fashion_news_frequency)) AS f, customer_id, count(*) AS n
        FROM sales JOIN customers USING (customer_id) GROUP BY ALL)
  WHERE f IN ('REGULARLY', 'NONE') GROUP BY f""",
    "q03": """
  SELECT postal_code, count(*) AS active_member_count,
         CAST(row_number() OVER (ORDER BY count(*) DESC, postal_code) AS INT) AS postal_rank
  FROM customers WHERE lower(club_member_status) = 'active'
  GROUP BY postal_code QUALIFY postal_rank <= 15""",
    "q04": """
  SELECT spend_quartile, avg(age) AS average_age, count(*) AS customer_count
  FROM (SELECT age, CAST(ntile(4) OVER (ORDER BY spent DESC, customer_id) AS INT) AS spend_quartile
        FROM (SELECT customer_id, sum(price) AS spent FROM sales GROUP BY customer_id)
        JOIN customers USING (customer_id) WHERE age IS NOT NULL)
  GROUP BY spend_quartile""",
    "q05": f"""
  SELECT department_name, {CHANNEL} AS channel_name, count(*) AS purchase_count
  FROM (SELECT *, count(*) OVER (PARTITION BY department_name) AS total
        FROM (SELECT coalesce(department_name, 'Unknown') AS department_name, sales_channel_id
              FROM sales JOIN articles USING (article_id) JOIN customers USING (customer_id) WHERE age < 25))
  GROUP BY department_name, sales_channel_id, total
  QUALIFY dense_rank() OVER (ORDER BY total DESC, department_name) <= 5""",
    "q06": """
  SELECT month_start, count(*) AS new_customers,
         CAST(sum(count(*)) OVER (ORDER BY month_start) AS BIGINT) AS cumulative_new_customers
  FROM (SELECT CAST(date_trunc('month', min(t_dat)) AS DATE) AS month_start FROM sales GROUP BY customer_id)
  GROUP BY month_start""",
    "q07": _weekly("year(t_dat)"),
    "q07_iso": _weekly("isoyear(t_dat)"),
    "q08": """
  SELECT product_group_name, winter_sales, summer_sales, winter_sales - summer_sales AS sales_spike,
         round(CASE WHEN greatest(winter_sales, summer_sales) > 0
               THEN CAST(winter_sales - summer_sales AS DOUBLE) / greatest(winter_sales, summer_sales) * 100
               ELSE 0 END, 6) AS seasonal_delta_pct,
         round(CASE WHEN winter_sales + summer_sales > 0
               THEN CAST(winter_sales AS DOUBLE) / (winter_sales + summer_sales) * 100
               ELSE 0 END, 6) AS seasonality_index
  FROM (SELECT product_group_name,
               count(*) FILTER (month(t_dat) IN (12, 1, 2)) AS winter_sales,
               count(*) FILTER (month(t_dat) IN (6, 7, 8)) AS summer_sales
        FROM sales JOIN articles USING (article_id)
        WHERE month(t_dat) IN (12, 1, 2, 6, 7, 8) GROUP BY product_group_name)""",
    "q09": _gaps("sales"),
    "q09_orders": _gaps("(SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS t_dat FROM orders)"),
    "q10": """
  SELECT month_start, t_dat, daily_revenue, monthly_revenue, monthly_median_daily,
         round(CAST(daily_revenue AS DOUBLE) / monthly_revenue, 6) AS monthly_share,
         round(CASE WHEN monthly_median_daily > 0
               THEN CAST(daily_revenue AS DOUBLE) / monthly_median_daily END, 6) AS peak_intensity_ratio,
         round(CASE WHEN sd > 0 THEN (daily_revenue - mean) / sd ELSE 0 END, 6) AS z_score,
         CAST(row_number() OVER (ORDER BY daily_revenue DESC, t_dat) AS INT) AS peak_rank
  FROM (SELECT t_dat, CAST(date_trunc('month', t_dat) AS DATE) AS month_start, count(*) AS daily_revenue
        FROM sales GROUP BY t_dat)
  JOIN (SELECT month_start, CAST(sum(n) AS BIGINT) AS monthly_revenue,
               quantile_disc(n, 0.5) AS monthly_median_daily, avg(n) AS mean, stddev_pop(n) AS sd
        FROM (SELECT t_dat, CAST(date_trunc('month', t_dat) AS DATE) AS month_start, count(*) AS n
              FROM sales GROUP BY t_dat)
        GROUP BY month_start) USING (month_start)
  QUALIFY peak_rank <= 10""",
    "q11": """
  SELECT t_dat, purchases_count, round(mean, 6) AS rolling_avg_7d, round(sd, 6) AS rolling_std_7d,
         round(mean + 2 * sd, 6) AS upper_band_2sigma,
         round(greatest(0.0, mean - 2 * sd), 6) AS lower_band_2sigma,
         purchases_count > round(mean + 2 * sd, 9) AS is_outlier
  FROM (SELECT *, avg(purchases_count) OVER w AS mean, stddev_pop(purchases_count) OVER w AS sd
        FROM (SELECT t_dat, count(*) AS purchases_count FROM sales JOIN customers USING (customer_id)
              WHERE age BETWEEN 30 AND 40 GROUP BY t_dat)
        WINDOW w AS (ORDER BY t_dat RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW))""",
    "q12": """
  SELECT club_member_status, day_of_week, purchases_count, segment_total_purchases,
         round(CAST(purchases_count AS DOUBLE) / segment_total_purchases * 100, 6) AS segment_day_share_pct,
         round(purchases_count / peers * 100, 6) AS weekday_index100
  FROM (SELECT *, CAST(sum(purchases_count) OVER (PARTITION BY club_member_status) AS BIGINT)
                    AS segment_total_purchases,
               avg(purchases_count) OVER (PARTITION BY day_of_week) AS peers
        FROM (SELECT club_member_status, CAST(dayofweek(t_dat) + 1 AS INT) AS day_of_week,
                     count(*) AS purchases_count
              FROM sales JOIN customers USING (customer_id)
              WHERE club_member_status IN ('ACTIVE', 'PRE-CREATE') GROUP BY ALL))""",
    "q13": f"""
  SELECT coalesce(index_group_name, 'unknown') AS index_group_name, sales_channel_id,
         {CHANNEL} AS channel_name, CAST(sum(price) AS DOUBLE) AS total_revenue
  FROM sales JOIN articles USING (article_id) GROUP BY ALL""",
    "q14": """
  SELECT weekday_num,
         CASE weekday_num WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
              WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday'
              WHEN 7 THEN 'Saturday' ELSE 'Unknown' END AS weekday_name,
         round(mean, 6) AS avg_revenue,
         CAST(dense_rank() OVER (ORDER BY mean DESC, weekday_num) AS INT) AS revenue_rank
  FROM (SELECT CAST(dayofweek(t_dat) + 1 AS INT) AS weekday_num,
               CAST(sum(price) AS DOUBLE) / count(price) AS mean
        FROM sales WHERE price > 2000 GROUP BY weekday_num)""",
    "q15": """
  SELECT assortment_segment, CAST(revenue AS DOUBLE) AS segment_revenue, segment_transactions,
         round(CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE) * 100, 6) AS revenue_share_pct
  FROM (SELECT CASE WHEN rn <= 10 THEN 'Top 10 products' ELSE 'Rest of assortment' END AS assortment_segment,
               sum(revenue) AS revenue, CAST(sum(n) AS BIGINT) AS segment_transactions
        FROM (SELECT prod_name, count(*) AS n, sum(price) AS revenue,
                     row_number() OVER (ORDER BY count(*) DESC, sum(price) DESC, prod_name) AS rn
              FROM (SELECT coalesce(prod_name, 'unknown product') AS prod_name, price
                    FROM sales JOIN articles USING (article_id) WHERE year(t_dat) = 1997)
              GROUP BY prod_name)
        GROUP BY assortment_segment)""",
    "q16": f"""
  SELECT month_start, CAST(revenue AS DOUBLE) AS monthly_revenue,
         CAST(before AS DOUBLE) AS previous_month_revenue, {_growth('revenue', 'before')} AS growth_rate_pct
  FROM (SELECT *, lag(revenue) OVER (ORDER BY month_start) AS before
        FROM (SELECT CAST(date_trunc('month', t_dat) AS DATE) AS month_start, sum(price) AS revenue
              FROM sales GROUP BY ALL))""",
    "q17": """
  SELECT round(CAST(sum(price) AS DOUBLE) / count(price), 6) AS avg_check_value,
         count(*) AS transaction_count, count(DISTINCT customer_id) AS customer_count,
         'Regular Fashion News Subscribers' AS segment_name
  FROM sales JOIN customers USING (customer_id) WHERE lower(trim(fashion_news_frequency)) = 'regularly'""",
    "q18": f"""
  SELECT t_dat, sales_channel_id, {CHANNEL} AS channel_name, CAST(sum(price) AS DOUBLE) AS daily_revenue,
         CAST(sum(sum(price)) OVER (PARTITION BY sales_channel_id ORDER BY t_dat
              ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total_revenue
  FROM sales WHERE year(t_dat) = 1997 GROUP BY t_dat, sales_channel_id""",
    "q19": """
  SELECT index_group_name, count(DISTINCT article_id) AS unique_articles FROM articles
  GROUP BY index_group_name""",
    "q20": _article_counts("department_name", "index_name = 'promo'"),
    "q21": """
  SELECT garment_group_name, prod_name, article_id, CAST(top AS DOUBLE) AS max_price,
         CAST(dense_rank() OVER (PARTITION BY garment_group_name ORDER BY top DESC) AS INT) AS price_rank
  FROM articles JOIN (SELECT article_id, max(price) AS top FROM sales GROUP BY article_id) USING (article_id)
  WHERE product_type_name = 'gear' QUALIFY price_rank <= 3""",
    "q22": f"""
  SELECT section_name, sales_count, CAST(sum(sales_count) OVER () AS BIGINT) AS total_sales,
         round(CAST(sales_count AS DOUBLE) / CAST(sum(sales_count) OVER () AS DOUBLE) * 100, 6)
           AS sales_share_pct
  FROM ({_article_counts('section_name', "lower(index_group_name) = 'large'")})""",
    "q23": _article_counts("index_group_name", "product_type_name = 'widget'"),
    "q24": """
  SELECT year_month, department_name, monthly_sales, dept_rank, prev_rank,
         prev_rank - dept_rank AS rank_change
  FROM (SELECT *, lag(dept_rank) OVER (PARTITION BY department_name ORDER BY year_month) AS prev_rank
        FROM (SELECT *, CAST(rank() OVER (PARTITION BY year_month ORDER BY monthly_sales DESC) AS INT)
                          AS dept_rank
              FROM (SELECT strftime(t_dat, '%Y-%m') AS year_month, department_name, count(*) AS monthly_sales
                    FROM sales JOIN articles USING (article_id) GROUP BY ALL)))""",
    "q25": """
  SELECT coalesce(perceived_colour_value_name, 'Unknown') AS perceived_colour_value_name,
         count(DISTINCT article_id) AS article_count
  FROM articles GROUP BY ALL""",
    "q26": """
  SELECT coalesce(colour_group_name, 'Unknown') AS colour_group_name, count(*) AS purchase_count
  FROM sales JOIN articles USING (article_id)
  WHERE lower(trim(graphical_appearance_name)) = 'ring'
  GROUP BY ALL ORDER BY purchase_count DESC, colour_group_name LIMIT 5""",
    "q27": """
  SELECT t_dat AS sale_date, count(*) AS daily_sales,
         round(avg(count(*)) OVER (ORDER BY t_dat ROWS 29 PRECEDING), 6) AS rolling_30d_avg
  FROM sales JOIN articles USING (article_id) WHERE lower(trim(colour_group_name)) = 'blue'
  GROUP BY t_dat""",
    "q28": f"""
  SELECT sales_channel_id, {CHANNEL} AS channel_name, graphical_appearance_name, n AS purchase_count,
         CAST(rn AS INT) AS pattern_rank
  FROM (SELECT sales_channel_id, coalesce(graphical_appearance_name, 'Unknown') AS graphical_appearance_name,
               count(*) AS n,
               row_number() OVER (PARTITION BY sales_channel_id
                                  ORDER BY count(*) DESC, coalesce(graphical_appearance_name, 'Unknown')) AS rn
        FROM sales JOIN articles USING (article_id) GROUP BY 1, 2)
  WHERE rn = 1""",
    "q29": f"""
  SELECT sales_channel_id, {CHANNEL} AS channel_name,
         round(CAST(sum(price) AS DOUBLE) / count(price), 6) AS avg_price, count(*) AS transaction_count
  FROM sales WHERE article_id IN (
    SELECT article_id FROM articles
    WHERE regexp_matches(concat_ws('|', lower(graphical_appearance_name), lower(prod_name),
                                   lower(detail_desc)), 'hot|gizmo'))
  GROUP BY sales_channel_id""",
    "q30": f"""
  SELECT month_start, CAST(revenue AS DOUBLE) AS monthly_revenue,
         CAST(before AS DOUBLE) AS previous_month_revenue, CAST(revenue - before AS DOUBLE) AS revenue_delta,
         {_growth('revenue', 'before')} AS growth_rate_pct
  FROM (SELECT *, lag(revenue) OVER (ORDER BY month_start) AS before
        FROM (SELECT CAST(date_trunc('month', t_dat) AS DATE) AS month_start, sum(price) AS revenue
              FROM sales JOIN articles USING (article_id)
              WHERE lower(trim(perceived_colour_master_name)) = 'red' GROUP BY ALL))""",
}

# Shapings, each a SELECT over the question it shapes, called src.
SHAPINGS = {
    "v01_gap_buckets": ("q09", GAP_BUCKETS),
    "v01_gap_buckets_by_order": ("q09_orders", GAP_BUCKETS),
    "v02_channel_shares": ("q13", f"""
  SELECT {_title('index_group_name')} AS index_group_name,
         round({_pct('store', 'store + online')} / 100, 6) AS "Store",
         round({_pct('online', 'store + online')} / 100, 6) AS "Online"
  FROM (SELECT index_group_name,
               coalesce(sum(CAST(total_revenue AS DECIMAL(28,2))) FILTER (channel_name = 'Store'), 0) AS store,
               coalesce(sum(CAST(total_revenue AS DECIMAL(28,2))) FILTER (channel_name = 'Online'), 0) AS online
        FROM src GROUP BY index_group_name)"""),
    "v03_department_channel_matrix": ("q05", """
  SELECT department_name,
         CAST(coalesce(sum(purchase_count) FILTER (channel_name = 'Store'), 0) AS BIGINT) AS "Store",
         CAST(coalesce(sum(purchase_count) FILTER (channel_name = 'Online'), 0) AS BIGINT) AS "Online",
         CAST(coalesce(sum(purchase_count) FILTER (channel_name = 'Channel 3'), 0) AS BIGINT) AS "Channel 3"
  FROM src GROUP BY department_name"""),
    "v04_section_pareto": ("q22", f"""
  SELECT {_title('section_name')} AS section_name, sales_count,
         round(CAST(sum(sales_count) OVER (ORDER BY sales_count DESC, section_name ROWS UNBOUNDED PRECEDING)
               AS DOUBLE) / CAST(sum(sales_count) OVER () AS DOUBLE) * 100, 6) AS cumulative_pct
  FROM (SELECT * FROM src ORDER BY sales_count DESC, section_name LIMIT 5)"""),
    "v05_category_shares": ("all_groups", f"""
  SELECT {_title('index_group_name')} AS index_group_name, sales_count,
         round_even(CAST(sales_count AS DOUBLE) / CAST(sum(sales_count) OVER () AS DOUBLE) * 100, 1) AS share_pct
  FROM src"""),
    "v06_best_rank_series": ("q24", f"""
  SELECT department_name, year_month, dept_rank
  FROM (SELECT {_title("coalesce(department_name, 'unknown')")} AS department_name, year_month, dept_rank,
               avg(dept_rank) OVER (PARTITION BY department_name) AS mean_rank FROM src)
  QUALIFY dense_rank() OVER (ORDER BY mean_rank, department_name) <= 10"""),
    "v07_observed_colours": ("q25", "SELECT * FROM src WHERE article_count > 0"),
    "v08_ranked_colours": ("q26", f"""
  SELECT CAST(row_number() OVER (ORDER BY purchase_count DESC, colour_group_name) AS INT) AS rank,
         {_title('colour_group_name')} AS colour_group_name, purchase_count,
         round(sqrt(CAST(purchase_count AS DOUBLE) / max(purchase_count) OVER ()), 6) AS relative_size
  FROM src"""),
    "v09_revenue_waterfall": ("q30", """
  SELECT month_start, strftime(month_start, '%Y-%m') AS month_label, monthly_revenue,
         coalesce(previous_month_revenue, 0) AS bar_base,
         coalesce(revenue_delta, monthly_revenue) AS bar_height,
         CASE WHEN row_number() OVER (ORDER BY month_start) = 1 THEN 'start'
              WHEN coalesce(revenue_delta, monthly_revenue) >= 0 THEN 'up' ELSE 'down' END AS bar_kind
  FROM src"""),
    "v10_weekday_matrix": ("q12", """
  SELECT day_of_week,
         coalesce(max(segment_day_share_pct) FILTER (club_member_status = 'ACTIVE'), 0) AS "ACTIVE",
         coalesce(max(segment_day_share_pct) FILTER (club_member_status = 'PRE-CREATE'), 0) AS "PRE-CREATE",
         CASE day_of_week WHEN 1 THEN 'Sun' WHEN 2 THEN 'Mon' WHEN 3 THEN 'Tue' WHEN 4 THEN 'Wed'
              WHEN 5 THEN 'Thu' WHEN 6 THEN 'Fri' ELSE 'Sat' END AS weekday
  FROM src GROUP BY day_of_week"""),
    "v11_weekly_labels": ("q07", """
  SELECT year || '-W' || lpad(CAST(week AS VARCHAR), 2, '0') AS year_week, transactions_count FROM src"""),
    "v11_top_seasonal_groups": ("q08", """
  SELECT product_group_name, summer_sales, winter_sales, sales_spike FROM src
  ORDER BY sales_spike DESC, product_group_name LIMIT 5"""),
    "v12_growth_signs": ("q16", """
  SELECT strftime(month_start, '%Y-%m') AS month_label, growth_rate_pct, growth_rate_pct >= 0 AS is_growth
  FROM src WHERE growth_rate_pct IS NOT NULL"""),
    "v13_quartile_label": ("q04", """
  SELECT 'Q' || spend_quartile || ' (Rank ' || spend_quartile || ')' AS spend_quartile_label, average_age
  FROM src"""),
    "v14_top_departments": ("q20", f"""
  SELECT {_title("coalesce(department_name, 'unknown')")} AS department_name, sales_count FROM src
  ORDER BY sales_count DESC, {_title("coalesce(department_name, 'unknown')")} LIMIT 15"""),
}

# Registered name of each question.
NAMES = {
    "q01": "q01_age_histogram", "q02": "q02_purchases_by_news", "q03": "q03_top_postal_codes",
    "q04": "q04_spend_quartiles", "q05": "q05_youth_departments", "q06": "q06_new_customers",
    "q07": "q07_weekly_dynamics", "q07_iso": "q07_weekly_dynamics_iso_year", "q08": "q08_seasonal_spike",
    "q09": "q09_retention_gaps", "q09_orders": "q09_retention_gaps_by_order", "q10": "q10_peak_days", "q11": "q11_rolling_activity",
    "q12": "q12_weekday_segments", "q13": "q13_revenue_by_group_channel", "q14": "q14_weekday_price_rank",
    "q15": "q15_top_product_share", "q16": "q16_monthly_growth", "q17": "q17_news_reader_check",
    "q18": "q18_running_revenue", "q19": "q19_articles_per_group", "q20": "q20_department_sales",
    "q21": "q21_priciest_per_group", "q22": "q22_section_shares", "q23": "q23_type_sales_by_group",
    "q24": "q24_department_rank_movement", "q25": "q25_assortment_by_colour_value",
    "q26": "q26_top_pattern_colours", "q27": "q27_colour_daily_average", "q28": "q28_top_pattern_per_channel",
    "q29": "q29_keyword_check_by_channel", "q30": "q30_monthly_change_filtered",
}

LINEITEM_TYPES = (
    "l_orderkey:bigint l_partkey:bigint l_suppkey:bigint l_linenumber:int l_quantity:double"
    " l_extendedprice:double l_discount:double l_tax:double l_returnflag:string l_linestatus:string"
    " l_shipdate:timestamp_ntz"
).split()

TABLE_WIDTHS = dict(zip(TABLES, (2, 3, 5, 4, 6, 6, 11, 6, 5, 3, 3, 2, 3, 4)))

HOLEY = """
holey AS (
  SELECT p_partkey, p_type, nullif(p_brand, 'Brand#4') AS p_brand,
         CASE WHEN p_size > 5 THEN p_size END AS p_size,
         CASE WHEN p_size > 3 THEN CASE WHEN p_size < 9 THEN CAST('nan' AS DOUBLE) ELSE p_retailprice END END
           AS p_retailprice,
         'EUR' AS currency
  FROM part
)"""


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


def _profile(keep: str, nan_is_missing: bool) -> str:
    parts = []
    for c in ("p_partkey", "p_type", "p_brand", "p_size", "p_retailprice", "currency"):
        missing = f"{c} IS NULL" + (f" OR isnan({c})" if nan_is_missing and c == "p_retailprice" else "")
        distinct = f"(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))"
        parts.append(f"""
  SELECT '{c}' AS "column", {distinct} AS n_distinct, count(*) FILTER ({missing}) AS n_missing,
         round(count(*) FILTER ({missing}) / count(*) * 100, 6) AS missing_pct,
         CASE WHEN '{c}' = '{keep}' THEN 'keep (core)' WHEN {distinct} = 1 THEN 'drop (constant)'
              ELSE 'keep' END AS verdict
  FROM holey""")
    return f"WITH {HOLEY} {_union(parts)}"


LINEITEM = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _lineitem_profile(sketched: bool) -> str:
    parts = []
    for c in LINEITEM:
        distinct = f"(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))"
        verdict = f"CASE WHEN {distinct} = 1 THEN 'drop (constant)' ELSE 'keep' END AS verdict"
        counts = f"count(*) - count({c}) AS n_missing"
        found = (f"{counts}, {verdict}, true AS within" if sketched else
                 f"{distinct} AS n_distinct, {counts}, round((count(*) - count({c})) / count(*) * 100, 6) AS missing_pct, {verdict}")
        parts.append(f"SELECT '{c}' AS \"column\", {found} FROM lineitem")
    return _union(parts)


def _null_counts() -> str:
    names = ("article_id prod_name colour_group_name graphical_appearance_name product_type_name"
             " index_group_name index_name department_name section_name garment_group_name"
             " product_group_name perceived_colour_value_name perceived_colour_master_name detail_desc").split()
    return f"WITH {BINDING} " + _union(
        [f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing FROM articles" for c in names])


def _describe() -> str:
    numeric = """SELECT '{c}' AS "column", count({c}) AS n_values, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS VARCHAR) AS minimum,
        CAST(max({c}) AS VARCHAR) AS maximum FROM part"""
    text = """SELECT 'p_brand' AS "column", count(p_brand) AS n_values, CAST(NULL AS DOUBLE) AS mean,
        CAST(NULL AS DOUBLE) AS stddev, min(p_brand) AS minimum, max(p_brand) AS maximum FROM part"""
    return _union([numeric.format(c="p_partkey"), text, numeric.format(c="p_size")])


def _clean_articles() -> str:
    others = ("department_name detail_desc garment_group_name index_name prod_name product_code"
              " product_group_name product_type_name section_name section_no").split()
    order = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in others)
    return f"""
WITH typed AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS article_id, lower(p_name) AS prod_name,
         lower(p_type) AS product_type_name, lower(split_part(p_name, ' ', 2)) AS product_group_name,
         lower(nullif(p_brand, 'Brand#4')) AS department_name, lower(p_type) AS index_name,
         lower(p_brand) AS section_name, 'group a' AS garment_group_name,
         lower(nullif(l_returnflag || ' ' || l_linestatus, 'N O')) AS detail_desc,
         CAST(l_suppkey AS INT) AS product_code, l_linenumber AS section_no
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand <> 'Brand#4'
)
SELECT * FROM typed QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY {order}) = 1"""


CLEAN_COUNTS = f"""
WITH {BINDING} SELECT count(*) AS before_rows,
       count(*) FILTER (department_name IS NOT NULL AND perceived_colour_value_name IS NOT NULL) AS after_rows,
       count(*) FILTER (department_name IS NULL OR perceived_colour_value_name IS NULL) AS removed_rows
FROM articles"""

QUALITY = {
    "load_check": "WITH n AS (SELECT count(*) AS n_rows FROM lineitem) " + _union([
        f"SELECT '{pair.split(':')[0]}' AS \"column\", {i} AS position, '{pair.split(':')[1]}' AS type,"
        " true AS nullable, n_rows FROM n" for i, pair in enumerate(LINEITEM_TYPES, 1)]),
    "dataset_inventory": _union([
        f"SELECT '{t}' AS dataset, count(*) AS n_rows, {TABLE_WIDTHS[t]} AS n_cols FROM {t}" for t in TABLES]),
    "verify_inferred_csv": """
SELECT 'part' AS dataset, count(*) AS n_rows, 6 AS n_cols, true AS ok, false AS error FROM part
UNION ALL SELECT 'absent', NULL, NULL, false, true""",
    "describe_columns": _describe(),
    "numeric_profile": """
SELECT 'o_totalprice' AS "column", min(o_totalprice) AS minimum, quantile_disc(o_totalprice, 0.25) AS q1,
       quantile_disc(o_totalprice, 0.5) AS median, quantile_disc(o_totalprice, 0.75) AS q3,
       max(o_totalprice) AS maximum, round(avg(o_totalprice), 4) AS mean,
       round(stddev_samp(o_totalprice), 4) AS stddev
FROM orders""",
    "numeric_profile_sketch": """
SELECT 'o_totalprice' AS "column", min(o_totalprice) AS minimum, max(o_totalprice) AS maximum,
       round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS stddev,
       true AS q1_within, true AS median_within, true AS q3_within
FROM orders""",
    "code_distribution": f"""
WITH {BINDING} SELECT sales_channel_id, count(*) AS n_rows FROM sales GROUP BY sales_channel_id""",
    "code_summary": f"""
WITH {BINDING} SELECT round(avg(sales_channel_id), 6) AS mean_code,
       count(DISTINCT sales_channel_id) AS n_codes FROM sales""",
    "profile_columns": _profile("p_partkey", False),
    "profile_columns_nan_aware": _profile("", True),
    "profile_purchases": _lineitem_profile(False),
    "profile_sketches": _lineitem_profile(True),
    "null_counts": _null_counts(),
    "duplicate_count": """
SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)) AS duplicate_rows
FROM lineitem""",
    "dedupe_by_key": """
SELECT l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY CAST(l_linenumber AS VARCHAR), l_linestatus,
                           l_returnflag, CAST(l_suppkey AS VARCHAR)) = 1""",
    "dedupe_by_columns": "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem",
    "drop_null_rows": f"""
WITH {BINDING} SELECT * FROM articles
WHERE department_name IS NOT NULL AND perceived_colour_value_name IS NOT NULL""",
    "require_columns": f"WITH {BINDING} SELECT * FROM articles WHERE department_name IS NOT NULL",
    "drop_constant_columns": "SELECT *, 1 AS unit FROM orders",
    "normalize_text": """
SELECT p_partkey, lower(trim(p_brand)) AS p_brand, lower(trim(p_type)) AS p_type FROM part""",
    "date_features": """
SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS t_dat, CAST(year(o_orderdate) AS INT) AS year,
       CAST(month(o_orderdate) AS INT) AS month, CAST(dayofweek(o_orderdate) + 1 AS INT) AS day_of_week
FROM orders""",
    "observed_clean_counts": CLEAN_COUNTS,
    "removal_report": CLEAN_COUNTS,
    "clean_transactions": """
SELECT CAST(o_orderdate AS DATE) AS t_dat, CAST(o_custkey AS VARCHAR) AS customer_id,
       lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS article_id,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price, l_linenumber AS sales_channel_id,
       CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
       CAST(dayofweek(o_orderdate) + 1 AS INT) AS day_of_week
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_discount <> 0 AND l_linenumber <> 7""",
    "clean_articles": _clean_articles(),
    "clean_customers": """
SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS customer_id, CAST(1 AS DOUBLE) AS "FN",
       c_mktsegment AS club_member_status, c_nationkey + 20 AS age, '00xyz' AS postal_code
FROM customer WHERE c_nationkey % 4 <> 0 AND c_nationkey <> 7""",
    "csv_source_transactions": f"""
WITH {BINDING} SELECT t_dat, CAST(customer_id AS VARCHAR) AS customer_id,
       CAST(article_id AS VARCHAR) AS article_id, CAST(price AS DOUBLE) AS price, sales_channel_id FROM sales""",
    "csv_source_articles": """
SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS article_id, CAST(p_partkey AS INT) AS product_code,
       p_name AS prod_name, nullif(p_brand, 'Brand#4') AS department_name,
       'a "' || p_name || '", ' || p_brand AS detail_desc
FROM part""",
    "csv_source_customers": f"""
WITH {BINDING} SELECT lpad(CAST(customer_id AS VARCHAR), 6, '0') AS customer_id,
       CASE WHEN age > 30 THEN CAST(1 AS DOUBLE) END AS "FN", CAST(1 AS DOUBLE) AS "Active",
       club_member_status, trim(fashion_news_frequency) AS fashion_news_frequency, age, postal_code
FROM customers""",
    "parquet_sink_partitioned": f"""
WITH {BINDING} SELECT t_dat, customer_id, article_id, CAST(price AS DOUBLE) AS price, sales_channel_id,
       CAST(year(t_dat) AS INT) AS year, CAST(month(t_dat) AS INT) AS month,
       CAST(dayofweek(t_dat) + 1 AS INT) AS day_of_week
FROM sales""",
    "publish_bundle": f"WITH {BINDING} {QUESTIONS['q13']}",
}


def oracle_sql() -> dict[str, str]:
    sources = {**QUESTIONS, "all_groups": _article_counts("index_group_name", "true")}
    questions = {NAMES[q]: f"WITH {BINDING} {sql}" for q, sql in QUESTIONS.items()}
    shapings = {name: f"WITH {BINDING}, src AS ({sources[q]}) {sql}" for name, (q, sql) in SHAPINGS.items()}
    return {**questions, **shapings, **QUALITY}
