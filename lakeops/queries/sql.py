"""Small helpers for writing check SQL."""


def money(expr: str) -> str:
    """Exact money sum as DOUBLE."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


def money_if(cond: str, expr: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN CAST({expr} AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE)"


# Fixed values of the check queries: the label ladders, written out apart from the code under test.
def recency(c: str) -> str:
    return (f"CASE WHEN {c} <= 7 THEN '01_7日以内' WHEN {c} <= 14 THEN '02_14日以内' WHEN {c} <= 30 THEN '03_30日以内' "
            f"WHEN {c} <= 60 THEN '04_60日以内' WHEN {c} <= 90 THEN '05_90日以内' WHEN {c} <= 150 THEN '06_150日以内' "
            f"WHEN {c} <= 180 THEN '07_180日以内' ELSE '08_それ以上' END")


def frequency(c: str) -> str:
    return (f"CASE WHEN {c} = 1 THEN '01_1回' WHEN {c} = 2 THEN '02_2回' WHEN {c} = 3 THEN '03_3回' "
            f"WHEN {c} BETWEEN 5 AND 10 THEN '04_5-10回' WHEN {c} BETWEEN 11 AND 20 THEN '05_11-20回' "
            f"WHEN {c} BETWEEN 21 AND 50 THEN '06_21-50回' WHEN {c} >= 51 THEN '07_50回以上' ELSE '00_その他' END")


def order_value(c: str) -> str:
    return (f"CASE WHEN {c} < 500 THEN '01_500円未満' WHEN {c} < 1000 THEN '02_500以上-1000円未満' "
            f"WHEN {c} < 2000 THEN '03_1000以上-2000円未満' WHEN {c} < 3000 THEN '04_2000以上-3000円未満' "
            f"WHEN {c} < 4000 THEN '05_3000以上-4000円未満' WHEN {c} < 5000 THEN '06_4000以上-5000円未満' "
            f"WHEN {c} < 10000 THEN '07_5000以上-10000円未満' ELSE '08_10000以上' END")


def frequency_group(c: str) -> str:
    return (f"CASE WHEN {c} BETWEEN 1 AND 2 THEN '01_1回〜2回' WHEN {c} BETWEEN 3 AND 10 THEN '02_3回〜10回' "
            f"WHEN {c} BETWEEN 11 AND 20 THEN '03_11回〜20回' WHEN {c} BETWEEN 21 AND 50 THEN '04_21回〜50回' ELSE '05_51回以上' END")


def price_range(c: str) -> str:
    return (f"CASE WHEN {c} >= 0 AND {c} < 1000 THEN '1_0円〜1000円未満' WHEN {c} >= 1000 AND {c} < 5000 THEN '2_1001円〜5000円未満' "
            f"WHEN {c} >= 5000 AND {c} < 10000 THEN '3_5001円〜10000円未満' "
            f"WHEN {c} >= 10000 AND {c} < 30000 THEN '4_10000円〜30000円未満' ELSE '5_30000円以上' END")
