"""Quality rules [native]: a threshold table compiled into one Spark projection, without user functions.

Definitions, for every text, whole:
  word         a maximal run of characters other than space and the five ASCII controls \\t \\n \\x0B \\f \\r
  line         what `\\n` splits; a blank line has no word
  null text    the empty text: no words, base_failed
Repeated rows are judged each by itself, ids are only carried, and columns beside doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_column

WS = "[ \\t\\n\\x0B\\f\\r]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
BASE_MIN_WORDS, BASE_MAX_REPEAT_PERCENT = 20, 30
#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that it for as with was on are by be this from or an at "
    "der die und den von das ist mit sich des dem nicht ein eine als auf im zu "
    "de la le et les des que un une en du dans pour qui est sur par pas au avec "
    "el los las y del se por con no una su para es al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """`value` is SQL over the measured columns; the text fails if it is under `least` or over `most`."""

    name: str
    value: str
    least: float | None = None
    most: float | None = None

    def failed(self) -> str:
        parts = [f"({self.value}) < {self.least}"] * (self.least is not None) + [f"({self.value}) > {self.most}"] * (self.most is not None)
        return " or ".join(parts)


#: Ratios are left as products so that no division by zero and no rounding decides.
RULES = (
    Rule("word_length_low", "word_chars - 2.0 * n_words", least=0),
    Rule("word_length_high", "word_chars - 25.0 * n_words", most=0),
    Rule("symbols_to_words", "n_symbols - 0.1 * n_words", most=0),
    Rule("exclamations_to_words", "n_exclamations - 0.5 * n_words", most=0),
    Rule("stop_words", "100.0 * n_stop_words - n_words", least=0),
    Rule("duplicate_lines", "n_dup_lines - 0.5 * n_lines", most=0),
    Rule("bullet_lines", "n_bullet_lines - 0.9 * n_lines", most=0),
    Rule("ellipsis_lines", "n_ellipsis_lines - 0.3 * n_lines", most=0),
)


def _bound(value: str, name: str, body: str) -> str:
    """SQL that evaluates `value` once and names it within `body`: Spark would compute a column anew for each element of a lambda."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _count(t: str, chars: str) -> str:
    """How often ASCII characters occur in t."""
    return " + ".join(f"(octet_length({t}) - octet_length(replace({t}, '{c}', '')))" for c in chars)


def repeat_words_sql(words: str) -> str:
    """Words that are in a WINDOW-word window found twice or more in the array `words`.

    A window is known by the 64-bit hash of its words' hashes (for a text of a million windows, two differ and agree with odds of 1e-8).
    Only texts that repeat a window sort (hash, position); coverage is then the sum of the steps between positions, WINDOW at most."""
    w = WINDOW
    covered = f"aggregate(p, named_struct('t', 0L, 'l', {-w}), (a, i) -> named_struct('t', a.t + least({w}, i - a.l), 'l', i), a -> a.t)"
    positions = "sort_array(transform(filter(s, (y, k) -> coalesce(get(s, k - 1).v = y.v, false) or coalesce(get(s, k + 1).v = y.v, false)), y -> y.i))"
    pairs = _bound("sort_array(transform(x, (v, i) -> named_struct('v', v, 'i', i)))", "s", _bound(positions, "p", covered))
    windows = f"transform(sequence(1, size(h) - {w - 1}), i -> xxhash64(slice(h, i, {w})))"
    some = _bound(windows, "x", f"case when size(array_distinct(x)) = size(x) then 0L else {pairs} end")
    return _bound(f"transform({words}, w -> xxhash64(w))", "h", f"case when size(h) <= {w} then 0L else {some} end")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and what the rules read, in one projection over the text."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    t = docs.select("doc_id", text_column().alias("t"))
    t = t.withColumn("w", F.expr(f"filter(split(t, r'{WS}+'), w -> w <> '')")).withColumn("l", F.expr(f"filter(split(t, '\\n'), l -> l rlike r'{WS.replace('[', '[^', 1)}')"))
    whole = {
        "n_words": "cast(size(w) as bigint)",
        "word_chars": f"cast(length(t) - ({_count('t', ' ')} + " + " + ".join(f"(octet_length(t) - octet_length(replace(t, chr({c}), '')))" for c in (9, 10, 11, 12, 13)) + ") as bigint)",
        "n_symbols": f"cast({_count('t', SYMBOLS)} as bigint)",
        "n_exclamations": f"cast({_count('t', '!')} as bigint)",
        "n_lines": "cast(size(l) as bigint)",
        "n_dup_lines": "cast(size(l) - size(array_distinct(l)) as bigint)",
        "n_bullet_lines": "cast(size(filter(l, x -> x rlike '^ *[-*•]')) as bigint)",
        "n_ellipsis_lines": "cast(size(filter(l, x -> x rlike '([.]{3}|…)$')) as bigint)",
        "n_stop_words": f"cast(size(filter(w, x -> lower(x) in ({stop}))) as bigint)",
        "n_repeat_words": f"cast({repeat_words_sql('w')} as bigint)",
    }
    return t.select("doc_id", *[F.expr(e).alias(k) for k, e in whole.items()])


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of docs: the measures, base_failed, kept, and the names of the rules that failed."""
    base: Column = F.expr(f"n_words < {BASE_MIN_WORDS} or 100 * n_repeat_words > {BASE_MAX_REPEAT_PERCENT} * n_words")
    failed = F.concat_ws(",", *[F.when(F.expr(r.failed()), F.lit(r.name)) for r in rules])
    return (
        measured(docs)
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), failed.alias("failed_rules"))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"), "failed_rules")
    )


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same in DuckDB SQL, with windows compared as lists of words."""
    ws, stop = r"[ \t\n\x0B\f\r]", ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    sym = "[#*$%&|<>]"
    names = ", ".join(f"case when {r.failed()} then '{r.name}' end" for r in rules)
    w = WINDOW
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
m as (
  select rid, doc_id, t, list_filter(regexp_split_to_array(t, '{ws}+'), lambda x: x <> '') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{ws.replace("[", "[^", 1)}')) as l from d),
win as (
  select rid, i, list_slice(w, i, i + {w - 1}) as g from (select rid, w, unnest(generate_series(1, len(w) - {w - 1})) as i from m where len(w) >= {w + 1})),
dup as (select rid, i from win qualify count(*) over (partition by rid, g) > 1),
cov as (select rid, sum(s) as n from (select rid, least({w}, coalesce(i - lag(i) over (partition by rid order by i), {w})) as s from dup) group by rid),
v as (
  select m.doc_id, len(w)::bigint as n_words,
    length(regexp_replace(t, '{ws}', '', 'g'))::bigint as word_chars,
    len(regexp_extract_all(t, '{sym}'))::bigint as n_symbols,
    len(regexp_extract_all(t, '!'))::bigint as n_exclamations,
    len(l)::bigint as n_lines,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^ *[-*•]')))::bigint as n_bullet_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '([.]{{3}}|…)$')))::bigint as n_ellipsis_lines,
    len(list_filter(w, lambda x: lower(x) in ({stop})))::bigint as n_stop_words,
    coalesce(cov.n, 0)::bigint as n_repeat_words
  from m left join cov using (rid)),
j as (
  select *, n_words < {BASE_MIN_WORDS} or 100 * n_repeat_words > {BASE_MAX_REPEAT_PERCENT} * n_words as base_failed, concat_ws(',', {names}) as failed_rules from v)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and failed_rules = '' as kept, failed_rules from j
"""
