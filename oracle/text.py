def rnd(x: str, n: int) -> str:
    """Half-up rounding on the decimal text of a double, as Spark's round does."""
    return f"CAST(ROUND(CAST(({x}) AS DECIMAL(38, 12)), {n}) AS DOUBLE)"


def ct(x: str) -> str:
    s = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    return f"(CASE WHEN {s} NOT IN ('', 'nan', 'NaN', 'None') THEN {s} END)"


def num(x: str) -> str:
    return f"(CASE WHEN isnan(TRY_CAST({x} AS DOUBLE)) THEN NULL ELSE TRY_CAST({x} AS DOUBLE) END)"


def day(x: str, fmt: str) -> str:
    return f"CAST(try_strptime(trim({x}), '{fmt}') AS DATE)"


def ambiguous(x: str) -> str:
    s = f"trim({x})"
    return (
        f"coalesce(regexp_full_match({s}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') AND TRY_CAST(substr({s}, 1, 2) AS INT) <= 12"
        f" AND TRY_CAST(substr({s}, 4, 2) AS INT) <= 12, FALSE)"
    )


def parsed(x: str) -> str:
    s = f"trim({x})"

    def m(p):
        return f"regexp_full_match({s}, '{p}')"

    return (
        f"(CASE WHEN {m(r'\d{4}-\d{2}-\d{2}')} THEN {day(x, '%Y-%m-%d')}"
        f" WHEN {m(r'\d{4}\.\d{2}\.\d{2}')} THEN {day(x, '%Y.%m.%d')}"
        f" WHEN {m(r'\d{2}-\d{2}-\d{4}')} THEN {day(x, '%d-%m-%Y')}"
        f" WHEN {m(r'\d{1,2} [A-Za-z]{3} \d{4}')} THEN {day(x, '%d %b %Y')}"
        f" WHEN {m(r'\d{2}/\d{2}/\d{4}')} THEN CASE WHEN TRY_CAST(substr({s}, 4, 2) AS INT) > 12"
        f" THEN {day(x, '%m/%d/%Y')} ELSE {day(x, '%d/%m/%Y')} END END)"
    )


def other_reading(x: str) -> str:
    return f"(CASE WHEN {ambiguous(x)} THEN {day(x, '%m/%d/%Y')} END)"


def digits(x: str, n: int, sign: bool = False) -> str:
    s = f"regexp_replace({x}, '\\.0$', '')"
    if sign:
        s = f"ltrim({s}, '-')"
    s = f"trim({s})"
    return f"(CASE WHEN regexp_full_match({s}, '\\d{{{n}}}') THEN {s} END)"


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def first(table: str, key: str, order: str = "SourceRow", cols: str = "*") -> str:
    return (
        f"(SELECT {cols} FROM {table} QUALIFY ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"
    )


def cint(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS BIGINT)"
