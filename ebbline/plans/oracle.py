"""The same answers as plain SQL on the given tables, written for DuckDB."""

from __future__ import annotations

from ebbline.functions import text as T
from ebbline.operators.finance import STATEMENT_MEASURES
from ebbline.operators.macro import MONTHLY_SERIES
from ebbline.operators.news import MONTHS, RATIO_COLUMNS
from ebbline.operators.prices import RETURNS
from ebbline.plans.features import feature_columns
from ebbline.plans.model_oracle import boosted_sql
from ebbline.plans.model_queries import BOOSTED, BOOSTED_BINS
from ebbline.plans.page_oracle import ARTICLE_LIST_EXTRACT, BODY_BY_SELECTOR, HTML_EXTRACT
from ebbline.plans.queries import DOC_DOUBTS, DOC_SUBJECT, DOC_TERMS, VIEWER, VIEWER_ARGS

END = "DATE '2001-06-30'"

CTE = {
    "companies": f"""
        SELECT code, name, failed AS bankruptcy, failed AS delisted_check,
               CASE WHEN failed THEN end_day END AS delisted_date,
               (end_day - INTERVAL 3 MONTH)::DATE AS pre_3m,
               (end_day - INTERVAL 6 MONTH)::DATE AS pre_6m,
               (end_day - INTERVAL 12 MONTH)::DATE AS pre_1y
        FROM (SELECT s_suppkey AS code, s_name AS name, s_suppkey % 7 = 0 AS failed,
                     {END} - (s_suppkey % 365)::INTEGER AS end_day FROM supplier)""",
    "horizons": """
        SELECT code, '3m' AS horizon, pre_3m AS as_of FROM companies
        UNION ALL SELECT code, '6m', pre_6m FROM companies
        UNION ALL SELECT code, '1y', pre_1y FROM companies""",
    "live": f"SELECT code, 'live' AS horizon, {END} AS as_of FROM companies WHERE NOT delisted_check",
    "lines": """
        SELECT l_suppkey AS code, l_orderkey AS order_key, l_linenumber AS line_number,
               l_shipdate::DATE AS day, round(l_quantity)::BIGINT AS qty,
               round(l_extendedprice * 100)::BIGINT AS cents, round(l_discount * 100)::BIGINT AS disc,
               round(l_tax * 100)::BIGINT AS tax, l_returnflag AS flag
        FROM lineitem""",
    "prices": """
        SELECT code, day,
               CASE WHEN max(line_number) <> 1
                    THEN sum(cents)::DOUBLE / sum(qty)::DOUBLE / 100::DOUBLE END AS close,
               sum(qty)::DOUBLE AS volume,
               (sum(qty) FILTER (flag = 'A'))::DOUBLE AS sell_foreign,
               (sum(qty) FILTER (flag = 'N'))::DOUBLE AS sell_inst,
               (sum(qty) FILTER (flag = 'R'))::DOUBLE AS sell_indiv,
               (sum(cents) FILTER (flag = 'A'))::DOUBLE / 100000::DOUBLE AS buy_foreign,
               (sum(cents) FILTER (flag = 'N'))::DOUBLE / 100000::DOUBLE AS buy_inst,
               (sum(cents) FILTER (flag = 'R'))::DOUBLE / 100000::DOUBLE AS buy_indiv,
               sum(disc)::DOUBLE / (count(*) * 100::DOUBLE) AS ret_1m,
               sum(tax)::DOUBLE / (count(*) * 100::DOUBLE) AS ret_3m,
               sum(disc - tax)::DOUBLE / (count(*) * 100::DOUBLE) AS ret_6m
        FROM lines GROUP BY code, day""",
    "fin0": """
        SELECT code, year(day) AS fiscal_year, sum(cents)::DOUBLE AS p, sum(cents * disc)::DOUBLE AS pd,
               sum(cents * tax)::DOUBLE AS pt,
               coalesce(sum(cents) FILTER (flag = 'R'), 0)::DOUBLE AS pr,
               coalesce(sum(cents) FILTER (flag = 'A'), 0)::DOUBLE AS pa,
               sum(qty)::DOUBLE AS q, count(*)::DOUBLE AS n
        FROM lines GROUP BY code, year(day)""",
    "fin1": "SELECT *, lag(p) OVER (PARTITION BY code ORDER BY fiscal_year) AS earlier FROM fin0",
    "finance": """
        SELECT code, fiscal_year, closing_month,
               last_day(make_date(fiscal_year, closing_month, 1)) + 90 AS deadline,
               total_assets, cash, total_debt, total_assets - total_debt AS equity, sales, net_income,
               pretax_income, operating_income, gross_profit, borrowing_dependence, net_margin,
               pretax_margin, operating_margin, gross_margin, asset_turnover, asset_growth,
               total_debt / total_assets AS debt_to_assets,
               CASE WHEN leverage > 52 THEN '완전잠식' ELSE leverage::VARCHAR END AS debt_ratio
        FROM (SELECT code, fiscal_year, CASE WHEN code % 5 = 0 THEN 3 ELSE 12 END AS closing_month,
                     p / 100::DOUBLE AS total_assets, pa / 100::DOUBLE AS cash,
                     (p * 100 - pd) * 0.6::DOUBLE / 10000::DOUBLE AS total_debt, q AS sales,
                     (pt - pd) / 10000::DOUBLE AS net_income, pt / 10000::DOUBLE AS pretax_income,
                     pd / 10000::DOUBLE AS operating_income, pr / 100::DOUBLE AS gross_profit,
                     pa / p AS borrowing_dependence, (pt - pd) / p AS net_margin, pt / p AS pretax_margin,
                     pd / p AS operating_margin, pr / p AS gross_margin,
                     n * 1000000::DOUBLE / p AS asset_turnover,
                     round((p - earlier) * 10000::DOUBLE / earlier) AS asset_growth,
                     floor(pd * 10 / p)::BIGINT AS leverage
              FROM fin1)""",
    "audits": """
        SELECT code, CASE WHEN disc <> 10 THEN day END AS report_date,
               CASE flag WHEN 'A' THEN true WHEN 'N' THEN false END AS n_opinion, order_key, line_number
        FROM lines""",
    "articles": """
        SELECT o_orderkey AS url, o_orderdate::DATE AS published_date,
               CASE WHEN NOT (o_orderstatus = 'P' AND o_totalprice < 50000)
                    THEN o_orderpriority = '1-URGENT' END AS related
        FROM orders""",
    "links": "SELECT l_suppkey AS code, l_orderkey AS url FROM lineitem",
    "pairs": "SELECT DISTINCT code, url FROM links",
    "oil": """
        SELECT date_trunc('month', o_orderdate)::DATE AS month,
               sum(round(o_totalprice * 100)::BIGINT)::DOUBLE / count(*)::DOUBLE / 100::DOUBLE AS oil_price
        FROM orders GROUP BY 1""",
    "rates": """
        SELECT date_trunc('month', day)::DATE AS month, sum(disc)::DOUBLE / count(*)::DOUBLE AS cd91,
               sum(tax)::DOUBLE / count(*)::DOUBLE AS bond3y, sum(qty)::DOUBLE / count(*)::DOUBLE AS usdkrw
        FROM lines GROUP BY 1""",
    "monthly": """
        SELECT coalesce(o.month, r.month) AS month, o.oil_price, o.oil_price / b.oil_price - 1 AS oil_price_yoy,
               r.cd91, r.bond3y, r.usdkrw
        FROM oil o LEFT JOIN oil b ON b.month = (o.month - INTERVAL 12 MONTH)::DATE
        FULL JOIN rates r ON r.month = o.month""",
    "gdp0": """
        SELECT year(o_orderdate) AS y, sum(round(o_totalprice * 100)::BIGINT)::DOUBLE AS t
        FROM orders GROUP BY 1""",
    "gdp": "SELECT a.y, a.t / b.t - 1 AS gdp_growth FROM gdp0 a LEFT JOIN gdp0 b ON b.y = a.y - 1",
}

NEEDS = {
    "horizons": ["companies"],
    "live": ["companies"],
    "prices": ["lines"],
    "fin0": ["lines"],
    "fin1": ["fin0"],
    "finance": ["fin1"],
    "audits": ["lines"],
    "pairs": ["links"],
    "rates": ["lines"],
    "monthly": ["oil", "rates"],
    "gdp": ["gdp0"],
}


def sql(uses: str, body: str, **more: str) -> str:
    """A statement with the named domain tables, and ``more`` tables after them, as CTEs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in NEEDS.get(name, []):
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in uses.split():
        visit(name)
    tables = [(n, CTE[n]) for n in ordered] + list(more.items())
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in tables) + "\n" + body


def cols(names, fmt="round({0}, 6) + 0 AS {0}") -> str:
    return ", ".join(fmt.format(n) for n in names)


# -- feature tables ----------------------------------------------------------------------


def statement_rows(dim: str, years: int, published: bool = True) -> str:
    cells = ", ".join(
        f"max({m}) FILTER (rn = {k}) AS y{k}_{m}" for k in range(1, years + 1) for m in STATEMENT_MEASURES
    )
    where = "WHERE deadline < as_of" if published else ""
    return f"""SELECT code, horizon, {cells} FROM (
        SELECT *, row_number() OVER (PARTITION BY code, horizon
                                     ORDER BY fiscal_year DESC, closing_month DESC) AS rn
        FROM finance JOIN {dim} USING (code) {where}) WHERE rn <= {years} GROUP BY code, horizon"""


def statement_names(years: int) -> list[str]:
    return [f"y{k}_{m}" for k in range(1, years + 1) for m in STATEMENT_MEASURES]


def share_rows(dim: str, bounds: list[tuple[int, int]]) -> str:
    parts = []
    for k, (lo, hi) in enumerate(bounds, start=1):
        for side in ("sell", "buy"):
            for who in ("foreign", "inst"):
                total = " + ".join(
                    f"coalesce(sum({side}_{i}) FILTER (age BETWEEN {lo} AND {hi}), 0)" for i in ("foreign", "inst", "indiv")
                )
                own = f"coalesce(sum({side}_{who}) FILTER (age BETWEEN {lo} AND {hi}), 0)"
                parts.append(f"{own} / nullif({total}, 0) AS {who}_{side}_{k}")
    deltas = [
        f"{w}_{s}_{k} - {w}_{s}_{k + 1} AS {w}_{s}_r{k}_r{k + 1}"
        for w in ("foreign", "inst")
        for s in ("sell", "buy")
        for k in (1, 2, 3)
    ]
    names = [d.rsplit(" AS ", 1)[1] for d in deltas]
    complete = " AND ".join(f"{n} IS NOT NULL" for n in names)
    return f"""SELECT * FROM (SELECT code, horizon, {", ".join(deltas)} FROM (
        SELECT code, horizon, {", ".join(parts)} FROM (
            SELECT *, as_of - day AS age FROM prices JOIN {dim} USING (code) WHERE close IS NOT NULL)
        GROUP BY code, horizon)) WHERE {complete}"""


SHARE_NAMES = [f"{w}_{s}_r{k}_r{k + 1}" for w in ("foreign", "inst") for s in ("sell", "buy") for k in (1, 2, 3)]
TRAIN_BOUNDS = [(1, 29), (32, 59), (62, 89), (92, 119)]
LIVE_BOUNDS = [(0, 30), (31, 60), (61, 90), (91, 120)]


def return_rows(dim: str, before: int) -> str:
    return f"SELECT code, horizon, {', '.join(RETURNS)} FROM prices JOIN {dim} USING (code) WHERE day = as_of - {before}"


def news_rows(dim: str) -> str:
    ratio = ", ".join(f"coalesce(max(n_related / n_all) FILTER (k = {k}), 0) AS m{k}" for k in range(1, MONTHS + 1))
    normal = ", ".join(f"coalesce(max(n_normal) FILTER (k = {k}), 0) AS m{k}_normal_num" for k in range(1, MONTHS + 1))
    related = ", ".join(
        f"coalesce(max(n_related) FILTER (k = {k}), 0) AS m{k}_bankruptcy_related_num" for k in range(1, MONTHS + 1)
    )
    return f"""SELECT d.code, d.horizon, {ratio}, {normal}, {related}
        FROM {dim} d LEFT JOIN (
            SELECT b.code, b.horizon, b.k, count(*) AS n_all, count(*) FILTER (related) AS n_related,
                   count(*) FILTER (NOT related) AS n_normal
            FROM (SELECT code, horizon, k, (as_of - k * INTERVAL 1 MONTH)::DATE AS lo,
                         (as_of - (k - 1) * INTERVAL 1 MONTH)::DATE AS hi
                  FROM {dim}, range(1, {MONTHS + 1}) r(k)) b
            JOIN pairs USING (code) JOIN articles USING (url)
            WHERE published_date BETWEEN lo AND hi
            GROUP BY b.code, b.horizon, b.k) m ON m.code = d.code AND m.horizon = d.horizon
        GROUP BY d.code, d.horizon"""


def macro_rows(dim: str, lag: str) -> str:
    cells = ", ".join(f"max({s}) FILTER (k = {k}) AS m{k}_{s}" for s in MONTHLY_SERIES for k in range(1, MONTHS + 1))
    return f"""SELECT b.code, b.horizon, {cells}
        FROM (SELECT code, horizon, k, (as_of - k * INTERVAL 1 MONTH)::DATE AS lo,
                     (as_of - (k - 1) * INTERVAL 1 MONTH)::DATE AS hi
              FROM {dim}, range(1, {MONTHS + 1}) r(k)) b
        LEFT JOIN (SELECT *, (month + INTERVAL 1 MONTH + {lag})::DATE AS pub FROM monthly) m
               ON m.pub <= b.hi AND m.pub > b.lo
        GROUP BY b.code, b.horizon"""


WEEK, NO_LAG = "INTERVAL 7 DAY", "INTERVAL 0 DAY"
MACRO_NAMES = [f"m{k}_{s}" for s in MONTHLY_SERIES for k in range(1, MONTHS + 1)]
GDP_NAMES = ["y1_gdp_growth", "y2_gdp_growth", "y3_gdp_growth"]


def gdp_rows(dim: str) -> str:
    cells = ", ".join(f"max(gdp_growth) FILTER (y = year(as_of) - {k}) AS y{k}_gdp_growth" for k in (1, 2, 3))
    return f"""SELECT code, horizon, {cells} FROM {dim} LEFT JOIN gdp ON y BETWEEN year(as_of) - 3 AND year(as_of) - 1
        GROUP BY code, horizon"""


def audit_rows(dim: str, published: bool = True) -> str:
    where = "WHERE report_date IS NULL OR report_date < as_of" if published else ""
    return f"""SELECT code, horizon, coalesce(bool_or(n_opinion), false) AS n_opinion_in_r3 FROM (
        SELECT *, row_number() OVER (PARTITION BY code, horizon
                                     ORDER BY report_date DESC NULLS LAST, order_key, line_number) AS rn
        FROM audits JOIN {dim} USING (code) {where}) WHERE rn <= 3 GROUP BY code, horizon"""


def feature_tables(dim: str, live: bool) -> dict[str, str]:
    return {
        "t_fin": statement_rows(dim, 2, not live),
        "t_share": share_rows(dim, LIVE_BOUNDS if live else TRAIN_BOUNDS),
        "t_ret": return_rows(dim, 0 if live else 1),
        "t_news": news_rows(dim),
        "t_audit": audit_rows(dim, not live),
        "t_macro": macro_rows(dim, NO_LAG if live else WEEK),
        "t_gdp": gdp_rows(dim),
    }


def feature_list() -> str:
    return ", ".join(n if n == "n_opinion_in_r3" else f"round({n}, 6) + 0 AS {n}" for n in feature_columns(2))


ALL = "companies horizons live prices finance audits articles pairs monthly gdp"
NOT_NULL = " AND ".join(f"{n} IS NOT NULL" for n in feature_columns(2))
COUNT_NAMES = [f"m{k}_normal_num" for k in range(1, 13)] + [f"m{k}_bankruptcy_related_num" for k in range(1, 13)]


CLOSE = "round(close::DECIMAL(38, 12), 6)::DOUBLE"  # decimal ties round as in Spark


# -- serving -----------------------------------------------------------------------------


def daily(measure: str, shown: str) -> str:
    return sql(
        "companies prices",
        f"""SELECT code, name, rn, day AS date, {shown} AS {measure} FROM (
            SELECT *, row_number() OVER (PARTITION BY code ORDER BY day DESC) AS rn
            FROM prices JOIN (SELECT code, name FROM companies WHERE NOT delisted_check) USING (code)
            WHERE isodow(day) < 6) WHERE rn <= 365""",
    )


def r3(x: str) -> str:
    return f"round(({x})::DECIMAL(18, 12), 3)::DOUBLE"


def shares(side: str, agg: str) -> str:
    total = " + ".join(f"{agg}({side}_{i})" for i in ("foreign", "inst", "indiv"))
    return ", ".join(
        r3(f"{agg}({side}_{i}) / nullif({total}, 0)") + f" AS {i}_{side}_share" for i in ("foreign", "inst", "indiv")
    )


def monthly_share(side: str) -> str:
    names = ", ".join(f"{i}_{side}_share" for i in ("foreign", "inst", "indiv"))
    return sql(
        "companies prices",
        f"""SELECT code, rn, strftime(month, '%Y-%m') AS month, {names} FROM (
            SELECT *, row_number() OVER (PARTITION BY code ORDER BY month DESC) AS rn FROM (
                SELECT code, date_trunc('month', day)::DATE AS month, {shares(side, "sum")}
                FROM prices JOIN (SELECT code FROM companies WHERE NOT delisted_check) USING (code)
                WHERE isodow(day) < 6 GROUP BY 1, 2)) WHERE rn <= 13""",
    )


def unit(c: str) -> str:
    return f"round(({c} / 100000::DOUBLE)::DECIMAL(18, 10), 2)::DOUBLE AS {c}"


# -- text --------------------------------------------------------------------------------

# Unicode classes spelled out, as this engine's own classes are ASCII.
SPACE = r"\s\p{Z}\x0b\x1c-\x1f\x85"
WORD = r"\p{L}\p{N}_"


def replaced(column: str, passes) -> str:
    out = column
    for pattern, to in passes:
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return out


CLEAN = replaced(
    "text",
    [
        (r"googletag.*\}\);", " "),
        (rf"[{SPACE}]+", " "),
        (r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9.-]+", ""),
        (rf"(?:http|ftp|https)://(?:[-{WORD}.]|(?:%[\p{{Nd}}a-fA-F]{{2}}))+", ""),
        (r"[ㄱ-ㅎㅏ-ㅣ]+", ""),
        (r"<[^>]*>", ""),
        (rf"[^{WORD}{SPACE}]", ""),
    ],
)
PRESS = replaced("html", [(rf"[{SPACE}]+", " "), (r"<.*> D", ""), (r"googletag.*\}\);", "")])
for _mark in [*T.PRESS_MARKS, "###", "***"]:
    PRESS = f"replace({PRESS}, '{_mark}', '')"


def any_term(column: str, terms) -> str:
    return "coalesce(" + " OR ".join(f"contains({column}, '{t}')" for t in terms) + ", false)"


def doubt(subject: str, doubts) -> str:
    return (
        "len(list_filter(string_split(text, '.'), lambda s: "
        f"contains(s, '{subject}') AND ({' OR '.join(f'''contains(s, '{d}')''' for d in doubts)}))) > 0"
    )


DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"

ORACLE: dict[str, str] = {
    "horizons": sql("horizons", "SELECT * FROM horizons"),
    "finance_deadline": sql("finance", "SELECT code, fiscal_year, closing_month, deadline FROM finance"),
    "debt_ratio": sql(
        "finance",
        "SELECT code, fiscal_year, round(debt_to_assets, 6) AS debt_to_assets, round(asset_growth, 6) AS asset_growth FROM finance",
    ),
    **{
        name: sql(
            "finance horizons",
            f"SELECT code, horizon, {cols(statement_names(years))} FROM t_fin WHERE "
            + " AND ".join(f"{n} IS NOT NULL" for n in statement_names(years)),
            t_fin=statement_rows("horizons", years),
        )
        for name, years in (("finance_asof_pivot", 2), ("finance_asof_pivot_3y", 3))
    },
    "stock_lookback": sql(
        "prices horizons",
        f"""SELECT code, horizon, day AS date, {CLOSE} AS close, round(volume, 6) AS volume
           FROM prices JOIN horizons USING (code) WHERE day BETWEEN as_of - 1 - 1096 AND as_of - 1""",
    ),
    "trade_share_delta": sql(
        "prices horizons", f"SELECT code, horizon, {cols(SHARE_NAMES)} FROM t", t=share_rows("horizons", TRAIN_BOUNDS)
    ),
    "trade_share_delta_live": sql(
        "prices live", f"SELECT code, horizon, {cols(SHARE_NAMES)} FROM t", t=share_rows("live", LIVE_BOUNDS)
    ),
    "return_snapshot": sql("prices horizons", f"SELECT code, horizon, {cols(RETURNS)} FROM t", t=return_rows("horizons", 1)),
    "return_snapshot_live": sql("prices live", f"SELECT code, horizon, {cols(RETURNS)} FROM t", t=return_rows("live", 0)),
    "news_ratio_12m": sql(
        "horizons pairs articles",
        f"SELECT code, horizon, {cols(RATIO_COLUMNS)}, {', '.join(COUNT_NAMES)} FROM t",
        t=news_rows("horizons"),
    ),
    "news_ratio_live": sql(
        "live pairs articles", f"SELECT code, horizon, {cols(RATIO_COLUMNS)}, {', '.join(COUNT_NAMES)} FROM t", t=news_rows("live")
    ),
    "macro_asof_12m": sql("horizons monthly", f"SELECT code, horizon, {cols(MACRO_NAMES)} FROM t", t=macro_rows("horizons", WEEK)),
    "macro_asof_live": sql("live monthly", f"SELECT code, horizon, {cols(MACRO_NAMES)} FROM t", t=macro_rows("live", NO_LAG)),
    "gdp_lag_3y": sql("horizons gdp", f"SELECT code, horizon, {cols(GDP_NAMES)} FROM t", t=gdp_rows("horizons")),
    "audit_any_doubt_r3": sql("horizons audits", audit_rows("horizons")),
    "training_mart": sql(
        ALL,
        f"""SELECT code, horizon, {feature_list()}, bankruptcy
            FROM t_fin JOIN t_share USING (code, horizon) JOIN t_ret USING (code, horizon)
            JOIN t_news USING (code, horizon) JOIN t_audit USING (code, horizon)
            JOIN t_macro USING (code, horizon) JOIN t_gdp USING (code, horizon)
            JOIN (SELECT code, bankruptcy FROM companies) USING (code) WHERE {NOT_NULL}""",
        **feature_tables("horizons", live=False),
    ),
    "live_features": sql(
        ALL,
        f"""SELECT code, {feature_list().replace("n_opinion_in_r3", "coalesce(n_opinion_in_r3, false) AS n_opinion_in_r3")}
            FROM live LEFT JOIN t_fin USING (code) LEFT JOIN t_share USING (code) LEFT JOIN t_ret USING (code)
            LEFT JOIN t_news USING (code) LEFT JOIN t_audit USING (code)
            LEFT JOIN t_macro USING (code) LEFT JOIN t_gdp USING (code)""",
        **feature_tables("live", live=True),
    ),
    "closing_price_365": daily("close", CLOSE),
    "volume_365": daily("volume", "volume"),
    "sell_share_daily": sql(
        "companies prices",
        f"""SELECT code, rn, day AS date, {shares("sell", "")} FROM (
            SELECT *, row_number() OVER (PARTITION BY code ORDER BY day DESC) AS rn
            FROM prices JOIN (SELECT code FROM companies WHERE NOT delisted_check) USING (code)
            WHERE isodow(day) < 6) WHERE rn <= 365""",
    ),
    "sell_share_monthly": monthly_share("sell"),
    "buy_share_monthly": monthly_share("buy"),
    "news_ratio_company": sql(
        "live pairs articles",
        " UNION ALL ".join(
            f"SELECT code, {k} AS month_back, {r3(f'm{k}')} AS ratio, m{k}_normal_num AS n_normal,"
            f" m{k}_bankruptcy_related_num AS n_related, m{k}_normal_num + m{k}_bankruptcy_related_num AS n_total FROM t"
            for k in range(1, 13)
        ),
        t=news_rows("live"),
    ),
    "news_ratio_cohort": sql(
        "companies horizons pairs articles",
        "SELECT horizon, bankruptcy, "
        + ", ".join(
            r3(f"sum(m{k}_bankruptcy_related_num) / nullif(sum(m{k}_bankruptcy_related_num) + sum(m{k}_normal_num), 0)")
            + f" AS m{k}_ratio"
            for k in range(1, 13)
        )
        + " FROM t JOIN companies USING (code) GROUP BY horizon, bankruptcy",
        t=news_rows("horizons"),
    ),
    "chart_series": sql(
        "companies prices",
        """SELECT code, '{"x":["' || string_agg(day::VARCHAR, '","' ORDER BY day DESC) || '"],"y":['
                  || string_agg(volume::BIGINT::VARCHAR, ',' ORDER BY day DESC) || ']}' AS series FROM (
           SELECT *, row_number() OVER (PARTITION BY code ORDER BY day DESC) AS rn
           FROM prices JOIN (SELECT code FROM companies WHERE NOT delisted_check) USING (code)
           WHERE isodow(day) < 6) WHERE rn <= 365 GROUP BY code""",
    ),
    "finance_4y": sql(
        "companies finance",
        f"""SELECT code, rn, fiscal_year, {unit("sales")}, {unit("net_income")}, {unit("operating_income")},
                   round(net_margin, 6) AS net_margin, round(operating_margin, 6) AS operating_margin,
                   {unit("total_assets")}, {unit("total_debt")}, debt_ratio,
                   round(debt_to_assets::DECIMAL(18, 12), 2)::DOUBLE AS debt_to_assets FROM (
            SELECT *, row_number() OVER (PARTITION BY code ORDER BY fiscal_year DESC, closing_month DESC) AS rn
            FROM finance JOIN (SELECT code FROM companies WHERE NOT delisted_check) USING (code)) WHERE rn <= 4""",
    ),
    "audit_latest3": sql(
        "companies audits",
        """SELECT code, rn, coalesce(year(report_date)::VARCHAR || '-' || month(report_date)::VARCHAR, '-') AS year_month,
                  CASE WHEN n_opinion THEN '예' ELSE '아니오' END AS n_opinion FROM (
           SELECT *, row_number() OVER (PARTITION BY code
                                        ORDER BY report_date DESC NULLS LAST, order_key, line_number) AS rn
           FROM audits JOIN (SELECT code FROM companies WHERE NOT delisted_check) USING (code)) WHERE rn <= 3""",
    ),
    "stock_unpivot_pivot": """
        SELECT user_id AS code, ts::DATE AS date, """
    + ", ".join(
        f"(sum(round(value * 100)::BIGINT) FILTER (event_type = '{i}'))::BIGINT AS {c}"
        for i, c in (("view", "views"), ("click", "clicks"), ("signup", "signups"), ("purchase", "purchases"), ("error", "errors"))
    )
    + " FROM events GROUP BY 1, 2",
    "fk_filter": sql(
        "companies prices",
        f"""SELECT code, day AS date, {CLOSE} AS close, round(volume, 6) AS volume FROM prices
           WHERE code IN (SELECT code FROM companies WHERE delisted_check)""",
    ),
    "filing_select": sql(
        "companies lines",
        f"""SELECT code, 'A-' || rn AS report_name, rpt_nm, day AS filed_on, '{VIEWER}?rcpNo=' || rcp_no AS url FROM (
            SELECT *, row_number() OVER (PARTITION BY code ORDER BY day DESC, rcp_no DESC) AS rn FROM (
                SELECT *, lag(period) OVER (PARTITION BY code ORDER BY day DESC, rcp_no DESC) AS newer FROM (
                    SELECT code, day, strftime(day, '%Y.%m') AS period, delisted_date,
                           '감사보고서 (' || strftime(day, '%Y.%m') || ')' AS rpt_nm,
                           strftime(day, '%Y%m%d') || lpad(order_key::VARCHAR, 12, '0') || line_number AS rcp_no
                    FROM lines JOIN companies USING (code)
                    WHERE flag <> 'R' AND (delisted_date IS NULL OR day <= delisted_date)))
            WHERE delisted_date IS NULL OR newer IS DISTINCT FROM period) WHERE rn <= 10""",
    ),
    "lookback_windows": sql(
        "companies",
        f"""SELECT code, 0 AS slice, (e - INTERVAL 36 MONTH)::DATE AS start_date, e AS end_date
            FROM (SELECT code, coalesce(delisted_date, {END}) AS e FROM companies)
            UNION ALL SELECT code, k, e - 183 * k::INTEGER + 1, e - 183 * (k::INTEGER - 1)
            FROM (SELECT code, coalesce(delisted_date, {END}) AS e FROM companies), range(1, 7) r(k)""",
    ),
    "articles_in_window": sql(
        "companies pairs articles",
        f"""SELECT code, url, published_date FROM pairs JOIN articles USING (url)
            JOIN (SELECT code, coalesce(delisted_date, {END}) AS e FROM companies) USING (code)
            WHERE published_date BETWEEN (e - INTERVAL 36 MONTH)::DATE AND e""",
    ),
    "article_tags": sql(
        "articles pairs",
        """SELECT url, count(code)::INTEGER AS n_tags, coalesce(string_agg(code::VARCHAR, ',' ORDER BY code), '') AS tags
           FROM articles LEFT JOIN pairs USING (url) GROUP BY url""",
    ),
    "article_tags_json": sql(
        "articles pairs",
        """SELECT url, published_date, related,
                  '[' || coalesce(string_agg(code::VARCHAR, ',' ORDER BY code), '') || ']' AS tags
           FROM articles LEFT JOIN pairs USING (url) GROUP BY ALL""",
    ),
    "array_membership": sql(
        "articles pairs",
        """SELECT url, published_date FROM articles
           WHERE url IN (SELECT url FROM pairs WHERE code = (SELECT min(s_suppkey) FROM supplier))""",
    ),
    "pending_urls": "SELECT DISTINCT l_orderkey AS url FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
    "article_bodies": sql(
        "articles",
        """SELECT url, published_date, related, n_chars, md5(text) AS body_md5
           FROM articles JOIN documents ON doc_id = url WHERE related IS NOT NULL AND text IS NOT NULL AND n_chars IS NOT NULL""",
    ),
    "union_sources": """
        SELECT doc_id AS url, lang AS news_comp, n_chars FROM documents
        UNION ALL SELECT page_id, 'web', length(html) FROM pages
        UNION ALL SELECT conv_id, role, length(text) FROM conversations""",
    "split_halves": """
        SELECT o_orderkey, CASE WHEN rn <= n // 2 + 1 THEN 1 ELSE 2 END AS part FROM (
            SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) AS rn, count(*) OVER () AS n
            FROM orders)""",
    "dq_report": sql(
        "companies links articles",
        """SELECT 'duplicate_keys' AS "check", 'companies' AS table_name, 'code' AS column_name, count(*) AS n
             FROM (SELECT code FROM companies GROUP BY 1 HAVING count(*) > 1)
           UNION ALL SELECT 'duplicate_keys', 'articles', 'url', count(*) FROM (SELECT url FROM articles GROUP BY 1 HAVING count(*) > 1)
           UNION ALL SELECT 'duplicate_keys', 'links', 'url', count(*) FROM (SELECT url FROM links GROUP BY 1 HAVING count(*) > 1)
           UNION ALL SELECT 'orphans', 'links', 'code', count(*) FROM links WHERE code NOT IN (SELECT code FROM companies)
           UNION ALL SELECT 'orphans', 'articles', 'url', count(*) FROM articles WHERE url NOT IN (SELECT url FROM links)
           UNION ALL SELECT 'nulls', 'articles', 'related', count(*) FROM articles WHERE related IS NULL
           UNION ALL SELECT 'nulls', 'companies', 'delisted_date', count(*) FROM companies WHERE delisted_date IS NULL
           UNION ALL SELECT 'rows', 'links', 'url', count(*) FROM links
           UNION ALL SELECT 'distinct', 'links', 'url', count(DISTINCT url) FROM links
           UNION ALL SELECT 'rows', 'companies', 'code', count(*) FROM companies
           UNION ALL SELECT 'distinct', 'companies', 'code', count(DISTINCT code) FROM companies
           UNION ALL SELECT 'positives', 'companies', 'bankruptcy', count(*) FROM companies WHERE bankruptcy""",
    ),
    "csv_round_trip": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "bulk_load_and_append": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "merge_upsert": """SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate >= DATE '1995-01-01' THEN 'N' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderdate >= DATE '1995-01-01' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""",
    "added_column": """SELECT c_custkey, c_name, n_orders FROM customer
        LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
    "csv_export": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "relabel_units": """SELECT o_custkey AS code, count(*) AS orders, round(count(*) FILTER (o_orderstatus = 'O') * 100::DOUBLE / count(*), 6) AS openp
        FROM orders GROUP BY 1""",
    "missing_marks": "SELECT doc_id, coalesce(toxic <> 0, false) AS toxic FROM documents LEFT JOIN labels USING (doc_id)",
    "month_group": sql(
        "articles",
        """SELECT date_trunc('month', published_date)::DATE AS month, count(*) AS n_all, count(*) FILTER (related) AS n_related,
                  count(*) FILTER (related IS NULL) AS n_unknown, strftime(date_trunc('month', published_date), '%Y-%m') AS label
           FROM articles GROUP BY 1, 5""",
    ),
    "latest_n_per_key": sql(
        "audits",
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code
           ORDER BY report_date DESC NULLS LAST, order_key, line_number) AS rn FROM audits) WHERE rn <= 3""",
    ),
    "anti_join_keys": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "distinct_count": """
        SELECT count(*) AS n_links, count(DISTINCT l_orderkey) AS n_urls, count(DISTINCT l_suppkey) AS n_codes,
               (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem)) AS n_pairs FROM lineitem""",
    "left_join_null_semantics": sql(
        "companies pairs articles",
        """SELECT c.code, count(a.url) AS n_all, count(*) FILTER (a.related) AS n_related,
                  round(coalesce(count(*) FILTER (a.related) / nullif(count(a.url), 0), 0), 6) AS ratio
           FROM companies c LEFT JOIN pairs p ON p.code = c.code LEFT JOIN articles a ON a.url = p.url GROUP BY c.code""",
    ),
    "class_share": sql("companies", "SELECT round(avg(bankruptcy::INTEGER), 6) AS share FROM companies"),
    "text_cleanse": f"SELECT doc_id, {CLEAN} AS text FROM documents",
    "press_cleanse": f"SELECT page_id, {PRESS} AS body FROM pages",
    "keyword_flag": f"""SELECT doc_id, {any_term("clean", DOC_TERMS)} AS related, {any_term("text", T.DISTRESS_TERMS)} AS related_fixed_terms
        FROM (SELECT doc_id, text, {CLEAN} AS clean FROM documents)""",
    "going_concern_flag": f"""SELECT doc_id, {doubt(DOC_SUBJECT, DOC_DOUBTS)} AS n_opinion,
        {doubt(T.GOING_CONCERN_SUBJECT, T.GOING_CONCERN_DOUBTS)} AS n_opinion_fixed_terms FROM documents""",
    "tokenize": f"""SELECT doc_id, len(tokens)::INTEGER AS n_tokens, array_to_string(tokens, ' ') AS tokens
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '([{WORD}]+)', 1) AS tokens FROM documents)""",
    "skipgram_pairs": f"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '([{WORD}]+)', 1) AS tokens FROM documents),
        placed AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS place FROM t),
        known AS (SELECT term FROM placed GROUP BY term HAVING count(*) >= 5),
        met AS (SELECT a.term, b.term AS context, 4 - (b.place - a.place) AS w FROM placed a JOIN placed b
            ON a.doc_id = b.doc_id AND b.place > a.place AND b.place <= a.place + 3),
        both_ways AS (SELECT term, context, w FROM met UNION ALL SELECT context, term, w FROM met)
        SELECT term, context, sum(w)::BIGINT AS weight FROM both_ways
        WHERE term IN (SELECT term FROM known) AND context IN (SELECT term FROM known) GROUP BY term, context""",
    "word_vectors": f"""WITH k AS (SELECT '<' || term || '>' AS marked, term FROM (
                SELECT unnest(regexp_extract_all(lower(text), '([{WORD}]+)', 1)) AS term FROM documents) GROUP BY term HAVING count(*) >= 5)
        SELECT term, 100::INTEGER AS dimensions, TRUE AS has_direction, (
            SELECT count(DISTINCT substr(marked, i, n)) FROM (SELECT unnest(range(1, len(marked) + 1)) AS i) a,
                (SELECT unnest(range(3, 7)) AS n) b WHERE i + n - 1 <= len(marked))::INTEGER AS n_runs FROM k""",
    "similar_terms": f"""SELECT vec_id, round({DOT.format(a="e.embedding", b="q.embedding")}
            / (sqrt({DOT.format(a="e.embedding", b="e.embedding")}) * sqrt({DOT.format(a="q.embedding", b="q.embedding")})), 5) AS similarity
        FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q
        WHERE vec_id <> 0 ORDER BY similarity DESC, vec_id LIMIT 30""",
    "html_extract": HTML_EXTRACT,
    "article_list_extract": ARTICLE_LIST_EXTRACT,
    "body_by_selector": BODY_BY_SELECTOR,
    "link_rebuild": f"""SELECT rcp_no, '{VIEWER}?' || """
    + " || '&' || ".join(
        f"'{n}=' || {v}"
        for n, v in zip(
            VIEWER_ARGS, ["rcp_no", "lpad(l_orderkey::VARCHAR, 12, '0')", "l_linenumber", "day", "l_suppkey", "'dart3.xsd'"]
        )
    )
    + """ AS url FROM (SELECT *, strftime(l_shipdate, '%Y%m%d') AS day,
            strftime(l_shipdate, '%Y%m%d') || lpad(l_orderkey::VARCHAR, 12, '0') || l_linenumber AS rcp_no FROM lineitem)""",
}

# -- resampling and metrics --------------------------------------------------------------

ML = "SELECT vec_id AS id, embedding::DOUBLE[] AS features, (label = 0)::INTEGER AS label FROM embeddings"
JUDGED = """SELECT doc_id, quality AS label, (n_chars >= 1000)::INTEGER AS prediction FROM labels JOIN documents USING (doc_id)"""


def hashed(*parts: str) -> str:
    text = " || '|' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"md5({text})"


def hash_number(*parts: str) -> str:
    return f"('0x' || substr({hashed(*parts)}, 1, 8))::BIGINT"


def split_rows(source: str, key: str) -> str:
    return f"""SELECT split, {key}, label, rn <= round(n * 0.25) AS is_test FROM (
        SELECT split, {key}, label, count(*) OVER (PARTITION BY split, label) AS n,
               row_number() OVER (PARTITION BY split, label ORDER BY {hashed(key, "20", "split")}, {key}) AS rn
        FROM {source}, range(1, 31) r(split))"""


def report(source: str, by: str = "") -> str:
    parts = []
    for c in (0, 1):
        tp = f"count(*) FILTER (label = {c} AND prediction = {c})"
        guessed, actual = f"count(*) FILTER (prediction = {c})", f"count(*) FILTER (label = {c})"
        parts += [
            f"coalesce({tp} / nullif({guessed}, 0), 0) AS precision_{c}",
            f"coalesce({tp} / nullif({actual}, 0), 0) AS recall_{c}",
            f"coalesce(2 * {tp} / nullif({guessed} + {actual}, 0), 0) AS f1_{c}",
        ]
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"SELECT {head}{', '.join(parts)}, count(*) FILTER (label = prediction) / count(*) AS accuracy FROM {source}{tail}"


SCORES = [f"{m}_{c}" for c in (0, 1) for m in ("precision", "recall", "f1")] + ["accuracy"]

DRAW_TABLES = {
    "ml": ML,
    "n": "SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1 FROM ml",
    "draws": f"""SELECT id AS token FROM (
        SELECT id, row_number() OVER (ORDER BY {hashed("id", "20")}, id) AS rn FROM ml WHERE label = 0), n WHERE rn <= n0 - n1""",
    "rare": f"SELECT *, row_number() OVER (ORDER BY {hashed('id', '20')}, id) AS rank FROM ml WHERE label = 1",
    "picked": f"""SELECT token, id, features FROM (
        SELECT token, {hash_number("token", "20", "'base'")} % n1 + 1 AS rank FROM draws, n) JOIN rare USING (rank)""",
}


def near_rows(candidates: str) -> str:
    """Brute-force neighbours of the rare rows."""
    return f"""SELECT id, neighbour, row_number() OVER (PARTITION BY id ORDER BY d, neighbour) AS pos FROM (
        SELECT a.id, b.id AS neighbour,
               list_sum(list_transform(list_zip(a.features, b.features), lambda p: (p[1] - p[2]) ** 2)) AS d
        FROM rare a JOIN {candidates} b ON a.id <> b.id) QUALIFY pos <= 5"""


POINTS = "id, token, label, round(list_sum(list_transform(features, lambda x, i: x * i)), 5) + 0 AS total, round(features[1], 5) + 0 AS first"
GIVEN = "SELECT id, NULL::BIGINT AS token, features, label FROM ml"

ORACLE |= {
    "stratified_split": f"WITH ml AS ({ML}) {split_rows('ml', 'id')}",
    "stratified_folds": f"""WITH ml AS ({ML}) SELECT id, label,
            (rn > round(n * 0.25))::INTEGER + (rn > round(n * 0.5))::INTEGER + (rn > round(n * 0.75))::INTEGER AS fold FROM (
        SELECT id, label, count(*) OVER (PARTITION BY label) AS n,
               row_number() OVER (PARTITION BY label ORDER BY {hashed("id", "20")}, id) AS rn FROM ml)""",
    "random_oversample": sql(
        "", f"SELECT {POINTS} FROM ({GIVEN} UNION ALL SELECT id, token, features, 1 FROM picked)", **DRAW_TABLES
    ),
    "smote": sql(
        "",
        f"""SELECT {POINTS} FROM ({GIVEN} UNION ALL
            SELECT p.id, p.token, list_transform(list_zip(p.features, o.features),
                   lambda z: z[1] + {hash_number("p.token", "20", "'gap'")} / 4294967296::DOUBLE * (z[2] - z[1])), 1
            FROM picked p JOIN near ON near.id = p.id AND near.pos = {hash_number("p.token", "20", "'neighbour'")} % 5 + 1
            JOIN rare o ON o.id = near.neighbour)""",
        **DRAW_TABLES,
        near=near_rows("rare"),
    ),
    "adasyn_allocation": sql(
        "",
        """SELECT id, coalesce(round_even(r / nullif(sum(r) OVER (), 0) * (n0 - n1), 0), 0)::BIGINT AS n_new FROM (
            SELECT near.id, sum((m.label = 0)::INTEGER)::DOUBLE AS r
            FROM near JOIN ml m ON m.id = near.neighbour GROUP BY near.id), n""",
        ml=ML,
        n=DRAW_TABLES["n"],
        rare="SELECT * FROM ml WHERE label = 1",
        near=near_rows("ml"),
    ),
    "classification_report": f"WITH j AS ({JUDGED}), r AS ({report('j')}) SELECT {cols(SCORES)} FROM r",
    "split_scoreboard": f"""WITH j AS ({JUDGED}), s AS ({split_rows("j", "doc_id")}),
        p AS (SELECT split, CASE WHEN is_test THEN 'test' ELSE 'train' END AS part, s.label, prediction
              FROM s JOIN j USING (doc_id)), r AS ({report("p", "split, part")})
        SELECT part, {cols(SCORES, "round_even(avg({0}), 3) AS {0}")} FROM r GROUP BY part""",
}

ORACLE |= {
    "boosted_scores": boosted_sql(BOOSTED, BOOSTED_BINS),
    "model_round_trip": f"SELECT id, TRUE AS same FROM ({ML})",
    # What must hold of any scores: who gets one, and that class probabilities are percentages of a whole.
    "score_audit": f"""WITH live AS ({ORACLE["live_features"]}), complete AS (
            SELECT DISTINCT code FROM live WHERE {" AND ".join(f"{c} IS NOT NULL" for c in feature_columns())}
            AND (SELECT count(DISTINCT horizon) FROM ({ORACLE["training_mart"]})) = 3)
        SELECT companies.code, complete.code IS NOT NULL AS scored, CASE WHEN complete.code IS NOT NULL THEN TRUE END AS adds_up
        FROM ({CTE["companies"]}) companies LEFT JOIN complete USING (code)""",
    "split_copies": f"""WITH ml AS ({ML}), s AS ({split_rows("ml", "id")}), t AS (
            SELECT split, id, label, row_number() OVER (PARTITION BY split, label ORDER BY {hashed("id", "20")}, id) AS rank,
                   count(*) FILTER (label = 0) OVER (PARTITION BY split) AS n0, count(*) FILTER (label = 1) OVER (PARTITION BY split) AS n1
            FROM s WHERE NOT is_test),
        drawn AS (SELECT split, {hash_number("id", "20", "'base'")} % n1 + 1 AS rank, count(*) AS n
                  FROM t WHERE label = 0 AND rank <= n0 - n1 GROUP BY ALL)
        SELECT s.split, s.id, s.label, is_test, CASE WHEN is_test THEN 0 ELSE 1 + coalesce(d.n, 0) END AS n_copies
        FROM s LEFT JOIN t ON t.split = s.split AND t.id = s.id AND t.label = 1
        LEFT JOIN drawn d ON d.split = t.split AND d.rank = t.rank""",
}
