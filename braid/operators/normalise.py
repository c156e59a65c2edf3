"""Normalised copies of evidence records: identity from the parent, categories, state tokens and order in time. Issues are `rules`' concern.

Records keep whatever else they hold, at any depth, so they stay JSON text and go through Python's parser in Arrow batches; the original column
isn't changed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import ship
from . import rules


def _seconds(text: object) -> float | None:
    first = str(text or "").split("-")[0].strip()
    minutes, colon, seconds = first.partition(":")
    try:
        value = float(seconds)
    except ValueError:
        return None
    return int(minutes) * 60 + value if colon and minutes.isdigit() and 0 <= value < 60 and seconds[:1].isdigit() else None


def _items(record: dict, section: str) -> list:
    found = record.get(section)
    return found if isinstance(found, list) else []


def micro(record: dict) -> dict:
    """Cookware is a tool, English state words are Chinese, and sections whose times all parse are in their order."""
    for section in rules.LIMITS["micro"]:
        for item in _items(record, section):
            if not isinstance(item, dict):
                continue
            for field in rules.STATE_FIELDS:
                word = item.get(field)
                if isinstance(word, str) and word.strip().lower() in rules.STATE_TOKENS:
                    item[field] = rules.STATE_TOKENS[word.strip().lower()]
            if section == "objects":
                name = str(item.get("name") or "")
                if "砧板" in name or name == "锅" or any(t in name for t in rules.COOKWARE):
                    item["category"] = "tool"
    for section, field in rules.TIME_ORDER.items():
        items = _items(record, section)
        times = [_seconds(x.get(field)) if isinstance(x, dict) else None for x in items]
        if len(items) >= 2 and None not in times:
            record[section] = [x for _, _, x in sorted(zip(times, range(len(items)), items), key=lambda t: t[:2])]
    return record


def identified(record: dict, parent: dict, layer: str) -> dict:
    """Identity fields as the parent has them, where it has them."""
    for field in (rules.RECORD_ID[layer], "source_video_id", *(("participant_id",) if layer == "session" else ())):
        if parent.get(field):
            record[field] = parent[field]
    return record


def normalised(df: DataFrame, layer: str, record: str = "record", parent: str = "parent", out: str = "normalised") -> DataFrame:
    """df with `out`: the JSON text of column `record`, given that of column `parent`; null where it isn't an object."""
    r, p = df.columns.index(record), df.columns.index(parent)

    def one(text: str | None, of: str | None) -> str | None:
        try:
            value, known = json.loads(text or ""), json.loads(of or "{}")
        except ValueError:
            return None
        if not isinstance(value, dict):
            return None
        value = identified(value, known if isinstance(known, dict) else {}, layer)
        return json.dumps(micro(value) if layer == "micro" else value, ensure_ascii=False, separators=(",", ":"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [one(x, y) for x, y in zip(b.column(r).to_pylist(), b.column(p).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())], [*b.schema.names, out])

    ship(df.sparkSession)
    return df.mapInArrow(run, f"{', '.join(f'`{n}` {t}' for n, t in df.dtypes)}, `{out}` string")
