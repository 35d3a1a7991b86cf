"""Independent SQL statements of the registered queries for the DuckDB
oracle. They follow the reference's own formulation (ROW_NUMBER dedup,
LAG, window frames, anti-joins, chains of full outer joins) rather than
the rewritten Spark plans, so agreement checks the rewrites."""

from __future__ import annotations

from ..operators.features import PER_SHARE_MEASURES, EXISTING_PER_SHARE, SHARES, per_share_names
from ..sources.fixtures import FUNDAMENTALS_RAW_SQL, RATIOS, TECHNICALS_FULL_SQL, TECHNICALS_RAW_SQL
from .inputs import SCREEN


def SUM2(x):
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,2))) AS DOUBLE)"


def AVG2(x, scale=2):
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,{scale}))) AS DOUBLE) / CAST(COUNT({x}) AS DOUBLE)"


def DEC(x, scale=12):
    """Spark's double -> decimal cast (via the shortest decimal form)."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,{scale}))"


def DSUM(x, scale=12):
    return f"CAST(SUM({DEC(x, scale)}) AS DOUBLE)"


def DAVG(x, scale=12):
    return f"{DSUM(x, scale)} / CAST(COUNT({x}) AS DOUBLE)"


CTES = {
    "technicals_raw": TECHNICALS_RAW_SQL,
    "technicals_full": TECHNICALS_FULL_SQL,
    "technicals_full_typed": "SELECT int64_field_0, Instrument, TRY_CAST(Date AS DATE) AS Date, TRY_CAST(Price_Close AS DOUBLE) AS Price_Close, Volume, "
        + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in RATIOS) + " FROM technicals_full",
    "fundamentals_raw": FUNDAMENTALS_RAW_SQL,
    "technicals_typed": """SELECT Instrument, TRY_CAST(Date AS DATE) AS Date,
        TRY_CAST(Price_Close AS DOUBLE) AS Price_Close, Volume FROM technicals_raw""",
    "technicals": """SELECT Instrument, Date, Price_Close, Volume,
        CAST(YEAR(Date) AS INTEGER) AS Year,
        CAST(CASE WHEN MONTH(Date) = 1 THEN 4 ELSE QUARTER(Date) END AS INTEGER) AS Quarter
      FROM technicals_typed
      WHERE Date IS NOT NULL AND Instrument IS NOT NULL AND Price_Close IS NOT NULL AND Volume IS NOT NULL""",
    "fund_clean": """SELECT *,
        CAST(CASE WHEN MONTH(Date) = 12 THEN YEAR(Date) + 1 ELSE YEAR(Date) END AS INTEGER) AS Year,
        CAST(CASE WHEN MONTH(Date) BETWEEN 3 AND 5 THEN 2 WHEN MONTH(Date) BETWEEN 6 AND 8 THEN 3
                  WHEN MONTH(Date) BETWEEN 9 AND 11 THEN 4 ELSE 1 END AS INTEGER) AS Quarter
      FROM fundamentals_raw WHERE Date IS NOT NULL AND Instrument IS NOT NULL""",
    "fundamentals": """SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY Date, Instrument ORDER BY Total_Revenue NULLS FIRST) AS rn
        FROM fund_clean) d WHERE rn = 1""",
    "joined": """SELECT * FROM technicals JOIN (SELECT * EXCLUDE (Date) FROM fundamentals) f
        USING (Instrument, Quarter, Year)""",
    "quarterly": f"""SELECT Instrument, Year, Quarter, {AVG2('Price_Close')} AS avg_price_close
        FROM technicals GROUP BY Instrument, Year, Quarter""",
    "annual": f"""SELECT *, dividends_sum / NULLIF(shares_avg, 0) AS dividend_per_share,
        earnings_sum / NULLIF(shares_avg, 0) AS eps FROM (
      SELECT Instrument, CAST(YEAR(Date) AS INTEGER) AS actual_year,
        {SUM2('Total_Revenue')} AS revenue,
        {AVG2('Total_Current_Assets')} AS assets,
        {AVG2('Total_Current_Liabilities')} AS liabilities,
        {AVG2('Total_Long_Term_Debt')} AS long_term_debt,
        {SUM2('Normalized_Income_Avail_to_Cmn_Shareholders')} AS earnings_sum,
        {AVG2('Normalized_Income_Avail_to_Cmn_Shareholders')} AS earnings_avg,
        {SUM2('Gross_Dividends___Common_Stock')} AS dividends_sum,
        {AVG2('Total_Common_Shares_Outstanding')} AS shares_avg,
        AVG(Book_Value_Per_Share) AS book_per_share_avg
      FROM fundamentals GROUP BY Instrument, YEAR(Date)) y""",
    "latest": f"""SELECT Instrument, MAX_BY(Price_Close, Date) AS Price FROM technicals
        WHERE YEAR(Date) = {SCREEN.current_year} GROUP BY Instrument""",
    "seqd": """SELECT *, ROW_NUMBER() OVER (PARTITION BY Instrument ORDER BY Date) - 1 AS seq,
        COUNT(*) OVER (PARTITION BY Instrument) AS n_rows FROM technicals""",
    "countries": f"""SELECT Country_of_Headquarters AS Instrument, Date, MAX(Price_Close) AS Price_Close, SUM(Volume) AS Volume,
        {", ".join(f"SUM({m}) AS {m}" for m in PER_SHARE_MEASURES)} FROM joined GROUP BY Country_of_Headquarters, Date""",
    "country_seq": """SELECT *, ROW_NUMBER() OVER (PARTITION BY Instrument ORDER BY Date) - 1 AS seq,
        COUNT(*) OVER (PARTITION BY Instrument) AS n_rows FROM countries""",
    "yearly": f"""SELECT Instrument, CAST(YEAR(Date) AS INTEGER) AS year, {AVG2('Price_Close')} AS avg_price
        FROM technicals GROUP BY Instrument, YEAR(Date)""",
    "growth": """SELECT *, (avg_price - LAG(avg_price) OVER (PARTITION BY Instrument ORDER BY year))
        / NULLIF(avg_price, 0) AS growth FROM yearly""",
    "baseline": """SELECT t.Instrument, t.Date, t.Price_Close, CAST(YEAR(t.Date) AS INTEGER) AS year,
        m.next_year_price FROM technicals t JOIN (
          SELECT g.Instrument, g.year + 1 AS year, g.avg_price * (1 + mg.mean_growth) AS next_year_price
          FROM growth g JOIN (SELECT Instrument, AVG(growth) AS mean_growth FROM growth GROUP BY Instrument) mg
          USING (Instrument)) m
        ON t.Instrument = m.Instrument AND YEAR(t.Date) = m.year
        WHERE m.next_year_price IS NOT NULL""",
}

DEPS = {
    "technicals_full_typed": ["technicals_full"],
    "technicals_typed": ["technicals_raw"],
    "technicals": ["technicals_typed"],
    "fund_clean": ["fundamentals_raw"],
    "fundamentals": ["fund_clean"],
    "joined": ["technicals", "fundamentals"],
    "quarterly": ["technicals"],
    "annual": ["fundamentals"],
    "latest": ["technicals"],
    "seqd": ["technicals"],
    "countries": ["joined"],
    "country_seq": ["countries"],
    "yearly": ["technicals"],
    "growth": ["yearly"],
    "baseline": ["growth", "technicals"],
}


def _closure(names):
    out = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(names, body: str) -> str:
    """``WITH`` the named building blocks (and what they read) + ``body``."""
    parts = [f"{n} AS ({CTES[n]})" for n in _closure(names)]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _screen_sql():
    p = SCREEN
    flagged = {
        "metric1": f"SELECT Instrument, 1 AS metric1 FROM annual WHERE actual_year = {p.current_year} AND revenue > 5000000",
        "metric2": f"SELECT Instrument, 1 AS metric2 FROM annual WHERE actual_year = {p.current_year} AND assets >= 2 * liabilities",
        "metric3": f"SELECT Instrument, 1 AS metric3 FROM annual WHERE actual_year = {p.current_year} AND assets - liabilities > long_term_debt",
        "metric4": f"""SELECT DISTINCT Instrument, 1 AS metric4 FROM annual a WHERE actual_year >= {p.since_year} AND earnings_avg > 0
            AND NOT EXISTS (SELECT 1 FROM annual n WHERE n.Instrument = a.Instrument AND n.actual_year >= {p.since_year} AND n.earnings_sum < 0)""",
        "metric5": f"""SELECT DISTINCT Instrument, 1 AS metric5 FROM annual a WHERE actual_year >= {p.since_year} AND dividend_per_share > 0
            AND NOT EXISTS (SELECT 1 FROM annual n WHERE n.Instrument = a.Instrument AND n.actual_year >= {p.since_year} AND n.dividend_per_share = 0)""",
        "metric6": f"""SELECT Instrument, 1 AS metric6 FROM (
              SELECT Instrument, MIN_BY(e, actual_year) AS f, MAX_BY(e, actual_year) AS l FROM (
                SELECT Instrument, actual_year, COALESCE(earnings_sum, 0) AS e FROM annual
                WHERE actual_year IN ({p.base_year}, {p.current_year})) x GROUP BY Instrument) g
            WHERE (l - f) / NULLIF(ABS(f), 0) >= 0.33""",
        "metric7": f"""SELECT a.Instrument, 1 AS metric7 FROM annual a JOIN latest USING (Instrument)
            WHERE actual_year = {p.current_year} AND Price <= 15 * eps""",
        "metric8": f"""SELECT a.Instrument, 1 AS metric8 FROM annual a JOIN latest USING (Instrument)
            WHERE actual_year = {p.current_year} AND Price * shares_avg <= 1.5 * book_per_share_avg * shares_avg""",
    }
    return flagged


SCREEN_FLAGS = _screen_sql()


def screen_body(metrics=None) -> str:
    ms = list(metrics or SCREEN_FLAGS)
    ctes = ", ".join(f"{m} AS ({SCREEN_FLAGS[m]})" for m in ms)
    joins = ms[0] + "".join(f" FULL OUTER JOIN {m} USING (Instrument)" for m in ms[1:])
    cols = ", ".join(f"CAST(COALESCE({m}, 0) AS INTEGER) AS {m}" for m in ms)
    return f"SELECT * FROM (WITH {ctes} SELECT Instrument, {cols} FROM {joins}) s"


def per_share_select() -> str:
    derived = ", ".join(f"{m} / NULLIF({SHARES}, 0) AS {m}_per_share" for m in PER_SHARE_MEASURES)
    feats = per_share_names()
    notnull = " AND ".join(f"{f} IS NOT NULL AND NOT isnan({f})" for f in feats)
    return (f"SELECT Instrument, Year, Quarter, {', '.join(feats)} FROM ("
            f"SELECT Instrument, Year, Quarter, {', '.join(EXISTING_PER_SHARE)}, {derived} FROM fundamentals) p "
            f"WHERE Instrument IS NOT NULL AND Year IS NOT NULL AND Quarter IS NOT NULL AND {notnull}")


def ratios_select() -> str:
    f = per_share_names()
    names, exprs = [], []
    for i in range(len(f) - 1):
        for j in range(i + 1, len(f)):
            names.append(f"{f[j]}_to_{f[i]}")
            exprs.append(f"{f[j]} / NULLIF({f[i]}, 0) AS {f[j]}_to_{f[i]}")
    notnull = " AND ".join(f"{n} IS NOT NULL AND NOT isnan({n})" for n in names)
    return (f"SELECT * FROM (SELECT Instrument, Year, Quarter, {', '.join(exprs)} FROM ({per_share_select()}) ps) r "
            f"WHERE {notnull}")


__all__ = ["with_ctes", "screen_body", "per_share_select", "ratios_select", "SUM2", "AVG2", "DSUM", "DAVG"]
