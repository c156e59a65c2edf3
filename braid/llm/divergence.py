"""Source divergence audit: how far the word shares of each source lie from those of the other sources of its language, by sort-based streaming.

A task reads whole documents, scans their (lang, term, source, document) runs and lets them go as (lang, term, source, documents, occurrences).
These are dealt out by (lang, term) and sorted by (lang, term, source); a run-length scan that holds one term at a time adds them up, and drops the
terms of too few documents. What is kept is dealt out again in buckets of terms, the totals of all sources of the language before the terms of each
bucket, and a second scan turns every run of a term into shares, partial sums for each pair of sources, and candidates for the list of terms.

A share is p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)): V the kept terms of the language, N their occurrences in the source (or in the
language). All arithmetic is on whole numbers, right for counts under 2 * 10**14.

Definitions, for every row:
  term         a maximal run of characters other than ASCII non-letters; A to Z are lower-cased, no other character is
  document     a row: repeated rows and repeated ids count each by itself
  null         text, lang and source are read as ''; a text without terms still makes its (lang, source) group occur
  ties         equal values are ranked by item, in the order of UTF-8 bytes
Only text, lang and source are read, whatever other columns there are. An empty table gives an empty result. A language without kept terms has pairs
of value 0 and no terms; a language of one source has no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import numtext as nt
from .common import ship, small, stored

#: Documents of its language that a term must be in, and terms listed for a source.
LEAST_DOCS, LISTED = 30, 50
SCALE, SMOOTH = 1_000_000_000, 5
#: Rows that a task adds up before it lets them go, numbers in a block of terms by sources, and pairs of sources that are added up within a bucket.
HELD, CELLS, PAIRS = 1 << 20, 1 << 21, 1 << 22
#: Rows of (term, source) in a bucket, about: a bucket lets go a row for each pair of sources, so there are as many buckets as the rows need.
BUCKET = 1 << 18

_TERM_BREAK = np.zeros(256, bool)
_TERM_BREAK[:128] = [not chr(i).isalpha() for i in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _runs_of(lang: pa.Array, source: pa.Array, text: pa.Array) -> Iterator[pa.Table]:
    """(lang, term, source, docs, n) of a batch, a row for each at most; term '' counts the documents of each (lang, source)."""
    group = pa.table({"lang": lang, "source": source}).append_column("row", pa.array(np.arange(len(text))))
    names = group.group_by(["lang", "source"], use_threads=False).aggregate([("row", "count")])
    code = group.join(names.drop(["row_count"]).append_column("code", pa.array(np.arange(len(names)))), ["lang", "source"], use_threads=False).sort_by("row").column("code").to_numpy()
    yield pa.table({"lang": names.column("lang"), "term": pa.array([""] * len(names)), "source": names.column("source"), "docs": names.column("row_count"), "n": pa.array(np.zeros(len(names), np.int64))})
    for i, _, buf, bounds in nt.groups(text, nt.PIECE * 4):
        starts, ends, row = nt.word_bounds(buf, bounds, _TERM_BREAK)
        if not len(starts):
            continue
        at = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=at[1:])
        letters = _LOWER[buf[~_TERM_BREAK[buf]]]
        terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(letters)).dictionary_encode()
        size = len(terms.dictionary)
        by_document, times = np.unique(row * size + terms.indices.to_numpy(), return_counts=True)
        by_source = code[i + by_document // size] * size + by_document % size
        order = np.argsort(by_source, kind="stable")
        by_source = by_source[order]
        first = np.flatnonzero(np.append(True, by_source[1:] != by_source[:-1]))
        which = pa.array(by_source[first] // size)
        docs = np.diff(np.append(first, len(by_source)))
        yield pa.table({"lang": names.column("lang").take(which), "term": terms.dictionary.take(pa.array(by_source[first] % size)), "source": names.column("source").take(which), "docs": pa.array(docs), "n": pa.array(np.add.reduceat(times[order], first))})


def _added_up(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(["lang", "term", "source"], use_threads=False).aggregate([("docs", "sum"), ("n", "sum")])
    return t.rename_columns(["lang", "term", "source", "docs", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of a task's documents, added up as far as HELD rows hold them."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        for t in _runs_of(*(batch.column(c) for c in ("lang", "source", "text"))):
            held.append(t)
            if sum(map(len, held)) > 2 * HELD:
                held = [_added_up(held)]
                if len(held[0]) > HELD:
                    yield from held.pop().to_batches(1 << 16)
    if held:
        yield from _added_up(held).to_batches(1 << 16)


def _changes(*columns: pa.ChunkedArray) -> np.ndarray:
    """Where a row differs from the one before it in any column; the first does."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return out


def _scan(least: int):
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of sorted (lang, term, source): one row each, for terms of `least` documents and for ''. The last term of a batch waits for the next."""
        held: pa.Table | None = None

        def judged(t: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            t = t.combine_chunks()
            term_new = _changes(t.column("lang"), t.column("term"))
            at = np.flatnonzero(term_new | _changes(t.column("source")))
            docs, n = (np.add.reduceat(t.column(c).to_numpy(), at) for c in ("docs", "n"))
            head = term_new[at]
            runs = t.select(["lang", "term", "source"]).take(pa.array(at))
            first = np.flatnonzero(head)
            whole = len(first) if last else len(first) - 1
            sizes = np.diff(np.append(first, len(at)))
            df, total = np.add.reduceat(docs, first), np.add.reduceat(n, first)
            keep = (df >= least) | pc.equal(pc.binary_length(runs.column("term").take(pa.array(first))), 0).to_numpy(zero_copy_only=False)
            keep[whole:] = False
            rows = np.flatnonzero(np.repeat(keep, sizes))
            out = runs.take(pa.array(rows))
            for name, x in (("docs", docs), ("n", n), ("in_lang", np.repeat(total, sizes)), ("head", (head & np.repeat(total > 0, sizes)).astype(np.int64))):
                out = out.append_column(name, pa.array(x[rows]))
            held = None
            if not last:
                rest = slice(int(first[-1]), None)
                held = runs[rest].append_column("docs", pa.array(docs[rest])).append_column("n", pa.array(n[rest]))
            yield from out.to_batches(1 << 16)

        for batch in batches:
            if batch.num_rows:
                t = pa.Table.from_batches([batch])
                yield from judged(pa.concat_tables([held, t]) if held is not None else t, False)
        if held is not None:
            yield from judged(held, True)

    return scanned


def counts(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """A row for each kept term and source that has it: lang, term, source, docs, n (occurrences), in_lang (of the whole language), head (1 on one row of
    each term). A row with term '' stands for each (lang, source). The table is stored."""
    ship(docs.sparkSession)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    rows = docs.select(*text).mapInArrow(_counted, "lang string, term string, source string, docs bigint, n bigint")
    rows = rows.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return stored(rows.mapInArrow(_scan(least), "lang string, term string, source string, docs bigint, n bigint, in_lang bigint, head bigint"))


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * count / total) without leaving 64 bits, for count <= total < 2 * 10**14."""
    step = 32_000
    whole, rest = np.divmod(count * (SCALE // step), total)
    return 1 + whole * step + rest * step // total


class _Bucket:
    """Sums over a bucket of a language's terms. Rows of `head` come first, then terms in order."""

    def __init__(self, lang: str, head: pa.Table):
        self.lang, self.sources = lang, head.column("source").combine_chunks()
        self.total = head.column("n").to_numpy() + SMOOTH * head.column("kept").to_numpy()
        self.in_lang = head.column("in_lang").to_numpy() + SMOOTH * head.column("kept").to_numpy()
        size = len(self.sources)
        self.sums = np.zeros((size, size), np.int64)
        self.listed = pa.table({"source": np.zeros(0, np.int64), "value": np.zeros(0, np.int64), "term": pa.array([], pa.string())})

    def add(self, t: pa.Table) -> Iterator[pa.RecordBatch]:
        """Rows of whole terms."""
        source = pc.index_in(t.column("source"), value_set=self.sources).to_numpy()
        n, in_lang = t.column("n").to_numpy(), t.column("in_lang").to_numpy()
        number = np.cumsum(_changes(t.column("term"))) - 1
        size, terms = len(self.sources), int(number[-1]) + 1
        step = max(1, CELLS // size)
        for lo in range(0, terms, step):
            a, b = np.searchsorted(number, [lo, lo + step])
            c = np.full((min(step, terms - lo), size), SMOOTH, np.int64)
            c[number[a:b] - lo, source[a:b]] += n[a:b]
            p = share(c, self.total)
            for s in range(size):
                self.sums[s] += np.abs(p - p[:, s : s + 1]).sum(0)
            f = p[number[a:b] - lo, source[a:b]] - share(in_lang[a:b] + SMOOTH, self.in_lang[source[a:b]])
            up = np.flatnonzero(f > 0)
            new = pa.table({"source": source[a:b][up].astype(np.int64), "value": f[up], "term": t.column("term").take(pa.array(a + up))})
            both = pa.concat_tables([self.listed, new])
            both = both.take(pc.sort_indices(both, [("source", "ascending"), ("value", "descending"), ("term", "ascending")]))
            s = both.column("source").to_numpy()
            self.listed = both.take(pa.array(np.flatnonzero(np.arange(len(s)) - np.searchsorted(s, s) < LISTED))).combine_chunks()
            if size * size > PAIRS:
                yield from self.pairs()

    def pairs(self) -> Iterator[pa.RecordBatch]:
        size = len(self.sources)
        for s in range(size):
            other = np.delete(np.arange(size), s)
            yield self._rows("pair", np.full(size - 1, s), self.sources.take(pa.array(other)), self.sums[s, other])
        self.sums[:] = 0

    def terms(self) -> pa.RecordBatch:
        t = self.listed.combine_chunks()
        return self._rows("term", t.column("source").to_numpy(), t.column("term").combine_chunks(), t.column("value").to_numpy())

    def _rows(self, part: str, source: np.ndarray, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"lang": pa.array([self.lang] * len(value), pa.string()), "source": self.sources.take(pa.array(source)), "part": pa.array([part] * len(value), pa.string()), "item": item.cast(pa.string()), "value": pa.array(value, pa.int64())})


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams (lang, bucket) groups: totals of all sources, then runs of terms. The last term of a batch waits for the next."""
    head: list[pa.Table] = []
    held: pa.Table | None = None
    bucket, key = None, None

    def ended() -> Iterator[pa.RecordBatch]:
        nonlocal head, held, bucket
        if head and bucket is None:
            bucket = _Bucket(key[0], pa.concat_tables(head))
        if held is not None:
            yield from bucket.add(held)
        if bucket is not None:
            yield from bucket.pairs()
            yield bucket.terms()
        head, held, bucket = [], None, None

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        at = np.flatnonzero(_changes(t.column("lang"), t.column("bucket"), t.column("of_term")))
        for a, b in zip(at, np.append(at[1:], len(t)), strict=True):
            part = t[a:b]
            if key != (part["lang"][0].as_py(), part["bucket"][0].as_py()):
                yield from ended()
                key = (part["lang"][0].as_py(), part["bucket"][0].as_py())
            if not part["of_term"][0].as_py():
                head.append(part)
                continue
            if bucket is None:
                bucket = _Bucket(key[0], pa.concat_tables(head))
            part = pa.concat_tables([held, part]).combine_chunks() if held is not None else part.combine_chunks()
            last = int(np.flatnonzero(_changes(part.column("term")))[-1])
            if last:
                yield from bucket.add(part[:last])
            held = part[last:]
    yield from ended()


def audited(docs: DataFrame, least: int = LEAST_DOCS, bucket: int = BUCKET) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: the other sources of the language by distance (the sum over kept terms of the difference of
    shares). Part `term`: up to LISTED kept terms that the source has and whose share in it is greater than in the language, by that difference."""
    kept = counts(docs, least)
    lang = Window.partitionBy("lang")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum("head").alias("h"), F.count("*").alias("rows"))
    totals = totals.select("lang", "source", "n", F.sum("n").over(lang).alias("in_lang"), F.sum("h").over(lang).alias("kept"), F.expr(f"1 + sum(rows) over (partition by lang) div {bucket}").alias("buckets"))
    totals = stored(totals)
    head, term = F.lit(False).alias("of_term"), F.lit(True).alias("of_term")
    heads = totals.select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("buckets") - 1)).alias("bucket"), head, F.lit("").alias("term"), "source", "n", "in_lang", "kept")
    langs = stored(totals.select("lang", "buckets").distinct())
    used = kept.where("term <> ''").join(small(langs), "lang")
    rows = used.select("lang", F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket"), term, "term", "source", "n", "in_lang", F.lit(0).cast("bigint").alias("kept"))
    dealt = heads.unionByName(rows).repartition("lang", "bucket").sortWithinPartitions("lang", "bucket", "of_term", "term", "source")
    partial = dealt.mapInArrow(_compared, "lang string, source string, part string, item string, value bigint")
    whole = partial.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return whole.withColumn("rank", rank).where(f"part = 'pair' or rank <= {LISTED}")


def oracle(least: int = LEAST_DOCS) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    p = f"(1 + ({SCALE}::hugeint * (c + {SMOOTH})) // (n + {SMOOTH} * v))::bigint"
    return f"""
with d as (select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), '{upper}', '{lower}') as t from documents),
w as (select rid, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
kept as (select lang, term from w group by lang, term having count(distinct rid) >= {least}),
c as (select lang, source, term, count(*) as c from w join kept using (lang, term) group by all),
v as (select lang, count(*) as v from kept group by lang),
g as (select lang, source, coalesce((select sum(c) from c where c.lang = x.lang and c.source = x.source), 0) as n, coalesce((select v from v where v.lang = x.lang), 0) as v
      from (select distinct lang, source from d) x),
p as (select g.lang, g.source, k.term, coalesce(c.c, 0) as c, {p.replace("(c +", "(coalesce(c.c, 0) +")} as p from g join kept k on k.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
l as (select lang, term, {p} as q from (select lang, term, sum(c) as c from c group by all) join (select lang, sum(n) as n, any_value(v) as v from g group by lang) using (lang)),
f as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce((select sum(abs(x.p - y.p)) from p x join p y on x.lang = y.lang and x.term = y.term where x.lang = a.lang and x.source = a.source and y.source = b.source), 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  union all
  select p.lang, p.source, 'term', p.term, p.p - l.q from p join l using (lang, term) where p.c > 0 and p.p > l.q)
select lang, source, part, item, value, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from f
qualify part = 'pair' or rank <= {LISTED}
"""
