"""DuckDB spellings of the library's scalar functions, built from the same constants.

Used only to write the independent SQL oracle of each registered query.
"""

from __future__ import annotations

from ..functions.constants import (ASCII_PUNCTUATION, DANISH_STOPWORDS, DATE_DMY_PATTERN,
                                   DATE_YMD_PATTERN, NON_WORD_CHARS, NUMBER_PATTERN,
                                   SPLIT_NON_ALNUM, TOKEN_PATTERN)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_text(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower({x}), {lit(NON_WORD_CHARS)}, '', 'g'), ' ', '', 'g')"


def basic_clean(x: str) -> str:
    return f"CASE WHEN {x} = {lit(chr(92) + 'N')} THEN {x} ELSE translate(lower({x}), {lit(ASCII_PUNCTUATION)}, '') END"


def word_count(x: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda s: s <> '')) AS INTEGER)"


def token_count(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {lit(TOKEN_PATTERN)})) AS INTEGER)"


def split_sentences(x: str) -> str:
    marked = f"regexp_replace({x}, '([.!?])\\s+', '\\1\n', 'g')"
    return f"list_filter(list_transform(regexp_split_to_array({marked}, '\\n+'), lambda s: trim(s)), lambda s: s <> '')"


def _valid_ymd(y: str, m: str, d: str) -> str:
    return (f"(CASE WHEN {y} BETWEEN 1 AND 9999 AND {m} BETWEEN 1 AND 12 AND {d} >= 1 "
            f"THEN {d} <= day(last_day(make_date({y}, {m}, 1))) ELSE false END)")


def is_number(x: str) -> str:
    return f"regexp_matches({x}, {lit(NUMBER_PATTERN)})"


def is_date(x: str) -> str:
    def g(p, i):
        return f"TRY_CAST(regexp_extract({x}, {lit(p)}, {i}) AS INTEGER)"
    ymd = (f"(regexp_matches({x}, {lit(DATE_YMD_PATTERN)}) AND "
           f"{_valid_ymd(g(DATE_YMD_PATTERN, 1), g(DATE_YMD_PATTERN, 2), g(DATE_YMD_PATTERN, 3))})")
    a, b, y = g(DATE_DMY_PATTERN, 1), g(DATE_DMY_PATTERN, 2), g(DATE_DMY_PATTERN, 3)
    dmy = (f"(regexp_matches({x}, {lit(DATE_DMY_PATTERN)}) AND "
           f"({_valid_ymd(y, a, b)} OR {_valid_ymd(y, b, a)}))")
    return f"({ymd} OR {dmy})"


def keep_not_date_numeric(x: str) -> str:
    return f"NOT coalesce({is_number(x)} OR {is_date(x)}, false)"


def tokenize(x: str) -> str:
    stop = "[" + ", ".join(lit(w) for w in DANISH_STOPWORDS) + "]"
    return (f"list_transform(list_filter(regexp_split_to_array({x}, {lit(SPLIT_NON_ALNUM)}), "
            f"lambda w: regexp_matches(w, '^\\p{{L}}+$') AND NOT list_contains({stop}, w)), lambda w: lower(w))")


def draw(seed, *keys: str) -> str:
    inner = " || ':' || ".join([lit(str(seed))] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"CAST(('0x' || substr(md5({inner}), 1, 15)) AS BIGINT)"


def r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


def shuffle_sentences(x: str, key: str, seed=0) -> str:
    p = f"string_split(coalesce(CAST({x} AS VARCHAR), ''), '.')"
    h = f"md5({lit(str(seed))} || ':' || {key} || ':' || CAST(i - 1 AS VARCHAR))"
    tagged = f"list_transform(list_slice({p}, 1, len({p}) - 1), lambda x, i: {{'h': {h}, 'p': x}})"
    return f"array_to_string(list_transform(list_sort({tagged}), lambda s: s.p), '.')"


def combine_answer_comment(a: str, c: str) -> str:
    return f"coalesce({a}, '') || '.' || coalesce({c}, '')"


def analyzer_tokens(x: str) -> str:
    return f"list_filter({tokenize(x)}, lambda t: length(t) >= 2)"


def tfidf_vocab_ctes(p: str, train: str, toks: str = "toks", min_df=1, max_df=1.0,
                     max_features: int | None = None) -> list[tuple[str, str]]:
    lo = f"{min_df}" if isinstance(min_df, int) else f"{float(min_df)} * n"
    hi = f"{max_df}" if isinstance(max_df, int) else f"{float(max_df)} * n"
    limit = f"LIMIT {max_features}" if max_features else ""
    return [
        (p + "n", f"SELECT count(*) AS n FROM {train}"),
        (p + "cf", f"SELECT t AS term, count(*) AS cf FROM (SELECT unnest({toks}) AS t FROM {train}) a GROUP BY t"),
        (p + "dfq", f"SELECT t AS term, count(*) AS df FROM (SELECT unnest(list_distinct({toks})) AS t FROM {train}) a GROUP BY t"),
        (p + "v0", f"SELECT term, cf, df FROM {p}cf JOIN {p}dfq USING (term), {p}n WHERE df >= {lo} AND df <= {hi}"),
        (p + "voc", f"""SELECT term, df, ln((1.0 + n) / (1.0 + df)) + 1 AS idf
                        FROM (SELECT * FROM {p}v0 ORDER BY cf DESC, term {limit}) v, {p}n"""),
    ]


def tfidf_weight_ctes(p: str, docs: str, id_col: str, voc: str, toks: str = "toks") -> list[tuple[str, str]]:
    return [
        (p + "tf", f"""SELECT {id_col}, t AS term, count(*) AS tf
                       FROM (SELECT {id_col}, unnest({toks}) AS t FROM {docs}) a GROUP BY {id_col}, t"""),
        (p + "w", f"SELECT {id_col}, term, tf * idf AS w FROM {p}tf JOIN {voc} USING (term)"),
        (p + "wt", f"SELECT {id_col}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {id_col})) AS weight FROM {p}w"),
    ]
