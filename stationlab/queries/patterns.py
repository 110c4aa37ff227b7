"""Baskets, itemsets and rules."""

from pyspark.sql import functions as F

from ..functions import cut as C
from ..operators import patterns as P
from .features import SEASON_SQL, TREND_SQL, _ladder_sql
from .registry import R, STATIONS, city_year, day, query, r8, rounded, station_flat, station_wide, table, with_views

COLS = ["priority", "status", "segment", "decade"]
ORDER_CATS = """cats AS MATERIALIZED (SELECT o_orderkey, o_orderpriority AS priority, nullif(o_orderstatus, 'P') AS status, c_mktsegment AS segment,
  CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER) AS decade FROM orders JOIN customer ON o_custkey = c_custkey)"""


def _order_cats(spark, d):
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.select(
        "o_orderkey",
        F.col("o_orderpriority").alias("priority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.col("c_mktsegment").alias("segment"),
        P.X.decade(F.year("o_orderdate")).alias("decade"),
    )


def _item(c):
    return f"'{c}=' || CAST({c} AS VARCHAR)"


@query("build_baskets", f"WITH {ORDER_CATS} SELECT o_orderkey, concat_ws('|', {', '.join(_item(c) for c in COLS)}) AS items FROM cats")
def build_baskets(spark, d):
    return P.build_baskets(_order_cats(spark, d), COLS).select("o_orderkey", F.array_join("items", "|").alias("items"))


def _sets_cte(cols, source, min_support):
    """Itemset counts: every item is one column's value, so a set is a group of a column subset."""
    items = ", ".join(f"CASE WHEN grouping({c}) = 0 THEN {_item(c)} END" for c in cols)
    complete = " AND ".join(f"(grouping({c}) = 1 OR {c} IS NOT NULL)" for c in cols)
    return f"""total AS MATERIALIZED (SELECT count(*) AS n FROM {source}),
    raw AS MATERIALIZED (SELECT list_sort(list_filter([{items}], lambda x: x IS NOT NULL)) AS items, count(*) AS freq FROM {source} GROUP BY CUBE ({', '.join(cols)})
      HAVING {complete}),
    sets AS MATERIALIZED (SELECT items, freq, freq / n AS support FROM raw, total WHERE len(items) > 0 AND freq >= ceil(n * {min_support}))"""


def _grown_sets_cte(cols, source, min_support):
    """The same table for many columns: sets grow by one larger item at a time, as bit strings of the rows they hold."""
    pairs = " UNION ALL ".join(f"SELECT r, {_item(c)} AS item FROM numbered WHERE {c} IS NOT NULL" for c in cols)
    return f"""numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS r FROM {source}), total AS MATERIALIZED (SELECT count(*) AS n FROM {source}),
    held AS MATERIALIZED (SELECT DISTINCT r, item FROM ({pairs})),
    often AS MATERIALIZED (SELECT item FROM held, total GROUP BY item, n HAVING count(*) >= ceil(n * {min_support})),
    ones AS MATERIALIZED (SELECT o.item, CAST(string_agg(CASE WHEN h.r IS NULL THEN '0' ELSE '1' END, '' ORDER BY x.r) AS BIT) AS bits
      FROM often o CROSS JOIN numbered x LEFT JOIN held h ON h.r = x.r AND h.item = o.item GROUP BY o.item),
    grown AS (SELECT [item] AS items, item AS last, bits FROM ones
      UNION ALL SELECT list_append(g.items, o.item), o.item, g.bits & o.bits FROM grown g JOIN ones o ON o.item > g.last, total
      WHERE bit_count(g.bits & o.bits) >= ceil(n * {min_support})),
    sets AS MATERIALIZED (SELECT items, CAST(bit_count(bits) AS BIGINT) AS freq, bit_count(bits) / n AS support FROM grown, total)"""


def _sets_sql(n_sets="sets"):
    return f"SELECT array_to_string(items, '|') AS items, len(items) AS size, freq, {R('support')} AS support FROM {n_sets}"


def _rules_cte(min_confidence):
    return f"""pairs AS MATERIALIZED (SELECT items, freq, support, unnest(items) AS c FROM sets WHERE len(items) > 1),
    rules AS MATERIALIZED (SELECT a.items AS antecedent, p.c AS consequent, p.freq / a.freq AS confidence, (p.freq / a.freq) / s.support AS lift, p.support AS support
      FROM pairs p JOIN sets a ON a.items = list_filter(p.items, lambda x: x <> p.c) JOIN sets s ON s.items = [p.c]
      WHERE p.freq / a.freq >= {min_confidence})"""


RULES_SQL = f"SELECT array_to_string(antecedent, '|') AS antecedent, consequent, {R('confidence')} AS confidence, {R('lift')} AS lift, {R('support')} AS support FROM rules"


def _set_rows(p):
    return rounded(p.itemsets.select(F.array_join("items", "|").alias("items"), F.size("items").cast("long").alias("size"), "freq", "support"), "support")


def _rule_rows(p):
    rows = p.rules.select(F.array_join("antecedent", "|").alias("antecedent"), F.col("consequent")[0].alias("consequent"), "confidence", "lift", "support")
    return rounded(rows, "confidence", "lift", "support")


@query("frequent_itemsets", f"WITH {ORDER_CATS}, {_sets_cte(COLS, 'cats', 0.02)} {_sets_sql()}")
def frequent_itemsets(spark, d):
    return _set_rows(P.mine(P.build_baskets(_order_cats(spark, d), COLS), 0.02, 0.2))


@query("association_rules", f"WITH {ORDER_CATS}, {_sets_cte(COLS, 'cats', 0.02)}, {_rules_cte(0.2)} {RULES_SQL}")
def association_rules(spark, d):
    return _rule_rows(P.mine(P.build_baskets(_order_cats(spark, d), COLS), 0.02, 0.2))


@query(
    "top_rules",
    f"""WITH {ORDER_CATS}, {_sets_cte(COLS, 'cats', 0.02)}, {_rules_cte(0.2)}
    SELECT array_to_string(antecedent, ', ') || ' -> ' || consequent AS rule, {R('confidence')} AS confidence, {R('lift')} AS lift FROM rules
    ORDER BY rules.confidence DESC, rules.lift DESC, rule LIMIT 10""",
)
def top_rules(spark, d):
    return rounded(P.top_rules(P.mine(P.build_baskets(_order_cats(spark, d), COLS), 0.02, 0.2).rules), "confidence", "lift")


PRECIP_SQL = "CASE WHEN {c} = 0 THEN 'no_rain' WHEN {c} < 1 THEN 'light_rain' WHEN {c} < 5 THEN 'moderate_rain' ELSE 'heavy_rain' END"


@query("precip_category", with_views("station_flat", f"SELECT station, CAST(d AS VARCHAR) AS d, {PRECIP_SQL.format(c='precipitation')} AS precip_category FROM station_flat"))
def precip_category(spark, d):
    return station_flat(spark, d).select("station", day("d").alias("d"), P.precip_category(F.col("precipitation")).alias("precip_category"))


@query("change_category", with_views("city_year", f"SELECT Country, City, Year, {_ladder_sql('TempChange', *C.CHANGE_LADDER)} AS change_category FROM city_year"))
def change_category(spark, d):
    return city_year(spark, d).select("Country", "City", "Year", C.ladder(F.col("TempChange"), *C.CHANGE_LADDER).alias("change_category"))


WEATHER = {}
for _s in STATIONS:
    WEATHER[f"{_s}_temp_category"] = _ladder_sql(f"{_s}_temp_mean", *C.TEMP_LADDER)
    WEATHER[f"{_s}_humidity_category"] = _ladder_sql(f"{_s}_humidity", *C.HUMIDITY_LADDER)
    WEATHER[f"{_s}_precip_category"] = PRECIP_SQL.format(c=f"{_s}_precipitation")
WEATHER["season"] = SEASON_SQL.format(c="DATE_PARSED")
_WEATHER_CATS = f"cats AS MATERIALIZED (SELECT {', '.join(f'{e} AS {n}' for n, e in WEATHER.items())} FROM station_wide)"


@query("weather_patterns", with_views("station_wide", RULES_SQL, f"{_WEATHER_CATS}, {_grown_sets_cte(list(WEATHER), 'cats', 0.05)}, {_rules_cte(0.3)}").replace("WITH ", "WITH RECURSIVE ", 1))
def weather_patterns(spark, d):
    return _rule_rows(P.weather_patterns(station_wide(spark, d), "DATE_PARSED"))


TEMPERATURE = {
    "Country": "Country",
    "temp_regime": _ladder_sql("AvgYearlyTemp", *C.REGIME_LADDER),
    "temp_change_category": _ladder_sql("TempChange", *C.CHANGE_LADDER),
    "decade": "CAST(floor(Year / 10) * 10 AS INTEGER)",
    "trend": TREND_SQL.format(c="TempChange", t=0.1, a="warming", b="cooling", o="stable"),
}
_TEMP_CATS = f"cats AS MATERIALIZED (SELECT {', '.join(f'{e} AS {n}' for n, e in TEMPERATURE.items())} FROM city_year)"


@query("temperature_patterns", with_views("city_year", RULES_SQL, f"{_TEMP_CATS}, {_sets_cte(list(TEMPERATURE), 'cats', 0.05)}, {_rules_cte(0.3)}"))
def temperature_patterns(spark, d):
    return _rule_rows(P.temperature_patterns(city_year(spark, d)))
