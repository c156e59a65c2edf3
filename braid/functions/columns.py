"""Scalar functions as column expressions: everything here stays in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- presence and casts


def blank_to_null(x: str | Column) -> Column:
    """Null and blank text mean the same: absent."""
    return F.nullif(F.trim(_c(x).cast("string")), F.lit(""))


def first_present(*names: str | Column) -> Column:
    """The first of several names for one value that is present."""
    return F.coalesce(*[blank_to_null(n) for n in names])


def safe_double(x: str | Column) -> Column:
    """Text or number to double; null if it isn't a finite number."""
    v = _c(x).try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), None).otherwise(v)


def safe_long(x: str | Column) -> Column:
    """Text to long: whole numbers only ('7.0' is none)."""
    return _c(x).cast("string").try_cast("bigint")


def truth(x: str | Column) -> Column:
    """'true' in any case; anything else is false."""
    return F.coalesce(F.lower(F.trim(_c(x).cast("string"))) == "true", F.lit(False))


def listed(x: str | Column, ids: Iterable[str] | None) -> Column:
    """Membership in a list from a command line; None selects all."""
    return F.lit(True) if ids is None else _c(x).isin(sorted(ids))


def parse_list(text: str | None, everything: str | None = None) -> list[str] | None:
    """Comma-separated names, trimmed, blanks dropped; None for none at all or for the word for everything."""
    if text is None or (everything is not None and text.strip().lower() == everything):
        return None
    return [x.strip() for x in text.split(",") if x.strip()] or None


# --- identifiers and paths


def slug(x: str | Column) -> Column:
    """Lower case with runs of other characters than letters, digits, `_.-` as one underscore, trimmed of `_.-`; null if nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(F.regexp_replace(_c(x), "[^A-Za-z0-9_.-]+", "_"), "^[_.-]+|[_.-]+$", "")), F.lit(""))


def participant_key(raw: str | Column, video: str | Column) -> Column:
    """EGO4D_P000007 for numbers, EGO4D_P_<slug> for names, EGO4D_UNKNOWN_<video> where there is none: unknown wearers never share a key."""
    text = blank_to_null(raw)
    name = F.nullif(F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""), F.lit(""))
    return F.when(text.rlike(r"^-?\d+$"), F.format_string("EGO4D_P%06d", text.try_cast("bigint"))).when(name.isNotNull(), F.concat(F.lit("EGO4D_P_"), name)).otherwise(F.concat(F.lit("EGO4D_UNKNOWN_"), _c(video)))


def canonical_participant(x: str | Column) -> Column:
    """p4 to P04, ego4d_p10 to EGO4D_P000010, other path-safe names as they are, else null."""
    t = F.trim(_c(x))
    short, long = F.regexp_extract(t, r"(?i)^p(\d+)$", 1), F.regexp_extract(t, r"(?i)^ego4d_p(\d+)$", 1)
    return F.when(short != "", F.format_string("P%02d", short.try_cast("bigint"))).when(long != "", F.format_string("EGO4D_P%06d", long.try_cast("bigint"))).when(path_safe(t), t)


def path_safe(x: str | Column) -> Column:
    """One path component: not empty, `.` or `..`, without slashes."""
    t = _c(x)
    return F.coalesce((t != "") & (t != ".") & (t != "..") & ~t.rlike(r"[/\\]"), F.lit(False))


def before_first(x: str | Column, sep: str = "_") -> Column:
    return F.split_part(_c(x), F.lit(sep), F.lit(1))


def numbered(prefix: str | Column, mark: str, n: str | Column, width: int = 3) -> Column:
    """prefix_s007; wider numbers keep all their digits."""
    return F.concat(_c(prefix), F.lit(f"_{mark}"), F.format_string(f"%0{width}d", _c(n).cast("int")))


def file_name(path: str | Column) -> Column:
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def stem(path: str | Column, suffixes: Iterable[str] = ()) -> Column:
    """File name without extension, then without each of the given suffixes."""
    s = F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")
    for x in suffixes:
        s = F.regexp_replace(s, f"{x}$", "")
    return s


def url_path(url: str | Column) -> Column:
    """Decoded path of a URL; null where it is none."""
    return F.try_url_decode(F.try_parse_url(_c(url), F.lit("PATH")))


def content_type(path: str | Column) -> Column:
    kinds = {"mp4": "video/mp4", "json": "application/json", "csv": "text/csv", "txt": "text/plain", "jpg": "image/jpeg", "png": "image/png", "html": "text/html"}
    ext = F.lower(F.regexp_extract(_c(path), r"\.([^./]+)$", 1))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(y) for kv in kinds.items() for y in kv]), ext), F.lit("application/octet-stream"))


def header_value(headers: str | Column, name: str) -> Column:
    """Value of a header whatever the case and dashes of its name."""
    norm = name.lower().replace("-", "").replace("_", "")
    return F.get(F.map_values(F.map_filter(_c(headers), lambda k, _: F.regexp_replace(F.lower(k), "[-_]", "") == norm)), F.lit(0))


# --- numbers and time


def clock_seconds(x: str | Column) -> Column:
    """HH:MM:SS(.f) to seconds; null unless it has three numeric parts."""
    p = F.split(_c(x), ":")
    part = lambda i: F.get(p, F.lit(i)).try_cast("double")
    return F.when(F.size(p) == 3, part(0) * 3600 + part(1) * 60 + part(2))


def relative_seconds(x: str | Column) -> Column:
    """MM:SS(.f), minutes unbounded, seconds under 60; else null."""
    t = F.trim(_c(x))
    return F.when(t.rlike(r"^\d+:[0-5]\d(\.\d+)?$"), F.split_part(t, F.lit(":"), F.lit(1)).try_cast("double") * 60 + F.split_part(t, F.lit(":"), F.lit(2)).try_cast("double"))


def log_duration(x: str | Column) -> Column:
    """Seconds after `Duration:` in a media tool's output."""
    g = lambda i: F.regexp_extract(_c(x), r"Duration:\s*(\d+):(\d+):(\d+(?:\.\d+)?)", i).try_cast("double")
    return g(1) * 3600 + g(2) * 60 + g(3)


def frame_rate(x: str | Column) -> Column:
    """60000/1001 as a number; 0 where it is none."""
    a, b = (F.split_part(_c(x), F.lit("/"), F.lit(i)).try_cast("double") for i in (1, 2))
    return F.coalesce(F.when(_c(x).contains("/"), F.try_divide(a, b)).otherwise(_c(x).try_cast("double")), F.lit(0.0))


def trimmed_number(x: str | Column, places: int = 3) -> Column:
    """Fixed decimals without trailing zeros: 12.500 is 12.5, 100.000 is 100."""
    t = F.format_string(f"%.{places}f", _c(x).cast("double"))
    return F.regexp_replace(F.regexp_replace(t, "(?<=\\..{0,12})0+$", ""), "\\.$", "") if places else t


def csv_cell(x: str | Column, kind: str) -> Column:
    """A cell as text: null empty, booleans true/false, lists joined by `|`, doubles with six decimals at most."""
    v = _c(x)
    if kind.startswith("array"):
        v = F.array_join(v.cast("array<string>"), "|")
    elif kind in ("double", "float"):
        v = trimmed_number(v, 6)
    return F.coalesce(v.cast("string"), F.lit(""))


def ratio(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def share(part: str | Column, whole: str | Column) -> Column:
    """part / whole within [0, 1]; null unless both are positive."""
    p, w = _c(part), _c(whole)
    return F.when((p > 0) & (w > 0), F.least(F.greatest(p / w, F.lit(0.0)), F.lit(1.0)))


def within(a: str | Column, b: str | Column, absolute: float, relative: float = 0.0) -> Column:
    """Whether two durations agree: within `absolute`, or that share of the first if it is more."""
    return F.abs(_c(a) - _c(b)) <= F.greatest(F.lit(absolute), F.abs(_c(a)) * relative)


def bounded_ceiling(x: str | Column) -> Column:
    """Seconds rounded up, with whole numbers that floats overshoot by a hair left as they are."""
    return F.ceil(_c(x) - 1e-9)


def linear_score(weights: Mapping[str, float]) -> Column:
    out = F.lit(0.0)
    for name, w in weights.items():
        out = out + F.col(name).cast("double") * F.lit(w)
    return out


# --- texts with markers


def first_marker(x: str | Column, markers: Iterable[str], context: str | None = None) -> Column:
    """The first marker that a text holds in any case, if it also holds the context."""
    t = F.lower(_c(x))
    found = F.get(F.filter(F.array(*[F.lit(m) for m in markers]), lambda m: F.contains(t, F.lower(m))), F.lit(0))
    return F.when(F.contains(t, F.lit(context.lower())), found) if context else found


def json_block(x: str | Column) -> Column:
    """JSON text in a model's answer: a fenced block, else all of it if it is braced, else from the first brace to the last; null without any."""
    strip = lambda v: F.regexp_replace(v, r"^\s+|\s+$", "")
    t = strip(_c(x))
    fenced = strip(F.regexp_extract(t, r"(?is)```(?:json)?\s*(.*?)```", 1))
    inner = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return F.when(fenced != "", fenced).when(t.rlike(r"(?s)^\{.*\}$"), t).otherwise(F.nullif(inner, F.lit("")))


def any_of(x: str | Column, terms: Iterable[str]) -> Column:
    return F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(_c(x), t))


def case_map(x: str | Column, table: Mapping[str, object], default: object = None) -> Column:
    """A closed set of values to others."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(y) for kv in table.items() for y in kv]), _c(x)), F.lit(default))


def matches_any(values: str | Column, wanted: Iterable[str]) -> Column:
    """Whether an array has one of the wanted texts, in any case; nothing wanted matches."""
    wanted = [w.strip().lower() for w in wanted]
    return F.arrays_overlap(F.transform(_c(values), lambda v: F.lower(F.trim(v))), F.array(*[F.lit(w) for w in wanted])) if wanted else F.lit(True)


def reasons(*rules: tuple[Column, str]) -> Column:
    """All that applies, in order: an array of the names of the conditions that hold."""
    return F.filter(F.array(*[F.when(c, F.lit(n)) for c, n in rules]), lambda x: x.isNotNull())


def distinct_texts(x: str | Column) -> Column:
    """Aggregate: distinct trimmed texts without blanks, sorted casefolded and then as they are."""
    t = F.collect_set(blank_to_null(x))
    return F.transform(F.sort_array(F.transform(t, lambda v: F.struct(casefolded(v).alias("k"), v.alias("v")))), lambda s: s["v"])


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, dict[str, str]]:
    """What full case folding changes in lower-cased text: characters that become one other, those they become, and those that become several. Made from
    Python's own tables."""
    one, several = {}, {}
    for i in range(0x110000):
        x = chr(i)
        if (y := x.lower()) == x and x.casefold() != y:
            (one if len(x.casefold()) == 1 else several)[x] = x.casefold()
    return "".join(one), "".join(one.values()), several


def casefolded(x: str | Column) -> Column:
    """Text for comparing and sorting without regard to case, by full case folding (ß as ss, ς as σ) where lower case alone isn't enough.

    Few texts hold a character that becomes several; only these go through the replacements."""
    c = F.lower(F.col(x) if isinstance(x, str) else x)
    old, new, several = _folds()
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in several.items()])
    wide = F.aggregate(pairs, c, lambda t, p: F.replace(t, p["a"], p["b"]))
    return F.translate(F.when(c.rlike(f"[{''.join(several)}]"), wide).otherwise(c), old, new)
