"""Chat formatting as a prefix tree: conversations that share initial turns share their tokens.

Template of a turn: `<|im_start|>` role, newline, text `<|im_end|>` newline. In texts and roles a backslash becomes two and `<|` becomes `<\\|`,
so a control string inside a text can't be mistaken for the template's own; a newline in a role becomes backslash n. `unescape` undoes it.

A node of the tree is a turn after a given path of turns. Conversations are laid in depth-first order (sorted by the chained digests of their
turns, so that a path sorts just before its continuations) and cut into packs of about PACK characters. A pack holds each of its nodes once, in
depth-first order, with
  parent            the node before it, -1 for a first turn
  start, end        its span in the pack's text; pos: the position id of its first token, as if its conversation stood alone
  attn              intervals of the pack's text that hold its ancestors, merged where they touch; a token attends to these and, causally, its own node
  loss_start/end    the span of an assistant's text, else empty
The unit is the code point. A pack restarts from the first turn, so a tree larger than a pack is split without losing a path; equal
conversations are one path, kept once, and conversations point to it by path_id. No task gathers a tree.

Rows of a conversation are ordered by turn, then role, then text; repeated rows are turns of their own. Null role and text: empty. Null conv_id:
one conversation. A conversation longer than a pack is a pack by itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, stored

PACK = 16_384
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def piece(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where in it the text is."""
    head = f"{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def paths(rows: DataFrame) -> DataFrame:
    """conv_id, path_id (digest of all turns), order (chained digests), turns."""
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    turns = turns.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, order = [], []
            for conv in b.column("turns").to_pylist():
                h, chain = b"", []
                for t in conv:
                    h = hashlib.sha256(h + f"{len(t['role'])}:{t['role']}{t['text']}".encode("utf-8", "surrogatepass")).digest()
                    chain.append(h.hex()[:16])
                ids.append(h.hex()), order.append("".join(chain))
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(ids), pa.array(order), b.column("turns")], ["conv_id", "path_id", "order", "turns"])

    kind = dict(rows.dtypes)["conv_id"]
    return mapped(turns, run, f"conv_id {kind}, path_id string, order string, turns array<struct<role:string,text:string>>")


_NODE = "array<struct<parent:int,start:int,end:int,pos:int,depth:int,role:string,loss_start:int,loss_end:int,attn:array<struct<start:int,end:int>>>>"
_PACK = f"pack_id string, text string, nodes {_NODE}, leaves array<struct<path_id:string,node:int>>"


class _Pack:
    def __init__(self) -> None:
        self.text: list[str] = []
        self.size = 0
        self.nodes: list[dict] = []
        self.leaves: list[dict] = []
        self.path: list[tuple[str, str, int]] = []  # of the last conversation, with node numbers

    def add(self, path_id: str, turns: list[dict]) -> None:
        same = 0
        while same < min(len(self.path), len(turns)) and self.path[same][:2] == (turns[same]["role"], turns[same]["text"]):
            same += 1
        del self.path[same:]
        for t in turns[same:]:
            parent = self.path[-1][2] if self.path else -1
            out, a, b = piece(t["role"], t["text"])
            before = self.nodes[parent] if self.path else None
            attn = [dict(x) for x in before["attn"]] if before else []
            if before and attn and attn[-1]["end"] == before["start"]:
                attn[-1]["end"] = before["end"]
            elif before:
                attn.append({"start": before["start"], "end": before["end"]})
            trained = t["role"] == TRAINED
            s = self.size
            self.nodes.append({"parent": parent, "start": s, "end": s + len(out), "pos": before["pos"] + before["end"] - before["start"] if before else 0, "depth": len(self.path), "role": t["role"], "loss_start": s + a if trained else s, "loss_end": s + b if trained else s, "attn": attn})
            self.text.append(out)
            self.size += len(out)
            self.path.append((t["role"], t["text"], len(self.nodes) - 1))
        self.leaves.append({"path_id": path_id, "node": self.path[-1][2] if self.path else -1})

    def row(self) -> dict:
        return {"pack_id": self.leaves[0]["path_id"], "text": "".join(self.text), "nodes": self.nodes, "leaves": self.leaves}


def packed(convs: DataFrame, pack: int = PACK) -> DataFrame:
    """The packs of the distinct paths of convs (from `paths`)."""
    distinct = convs.groupBy("path_id").agg(F.any_value("order").alias("order"), F.any_value("turns").alias("turns"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(_PACK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = _Pack(), []
        for b in batches:
            for path_id, turns in zip(b.column("path_id").to_pylist(), b.column("turns").to_pylist(), strict=True):
                if now.leaves and now.size >= pack:
                    rows.append(now.row())
                    now = _Pack()
                now.add(path_id, turns)
            if len(rows) >= 64:
                yield from pa.Table.from_pylist(rows, schema).to_batches()
                rows = []
        if now.leaves:
            rows.append(now.row())
        if rows:
            yield from pa.Table.from_pylist(rows, schema).to_batches()

    return mapped(distinct.repartitionByRange("order", "path_id").sortWithinPartitions("order", "path_id"), run, _PACK)


def read_back(packs: DataFrame) -> DataFrame:
    """path_id and, from the pack alone, the contract's digests of the conversation there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("path_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, nodes, leaves in zip(b.column("text").to_pylist(), b.column("nodes").to_pylist(), b.column("leaves").to_pylist(), strict=True):
                for leaf in leaves:
                    way, k = [], leaf["node"]
                    while k >= 0:
                        way.append(nodes[k])
                        k = nodes[k]["parent"]
                    way.reverse()
                    formatted = "".join(text[n["start"] : n["end"]] for n in way)
                    turns = parse(formatted)
                    loss = "".join(unescape(text[n["loss_start"] : n["loss_end"]]) for n in way)
                    out["path_id"].append(leaf["path_id"])
                    out["n_turns"].append(len(turns))
                    out["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass")).hexdigest())
                    out["loss_chars"].append(len(loss))
                    out["loss_sha256"].append(hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest())
                    out["formatted_chars"].append(len(formatted))
            yield pa.RecordBatch.from_pydict(out, pa.schema([("path_id", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

    return mapped(packs, run, "path_id string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def formatted(rows: DataFrame, pack: int = PACK) -> tuple[DataFrame, DataFrame]:
    """conv_id and path_id; and the packs."""
    convs = stored(paths(rows))
    return convs.select("conv_id", "path_id"), stored(packed(convs, pack))


def oracle(extra: str) -> str:
    """DuckDB SQL for the digests, from the turns; `extra` is SQL for rows to append."""
    esc = lambda x, role=False: f"replace(replace({x}, '\\', '\\\\'), '<|', '<\\|')" if not role else f"replace(replace(replace({x}, '\\', '\\\\'), '<|', '<\\|'), chr(10), '\\n')"
    return f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all {extra})
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = '{TRAINED}'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = '{TRAINED}'), '')) as loss_sha256,
  sum(length({esc("role", True)}) + length({esc("text")}) + {len(START) + len(END) + 2})::bigint as formatted_chars
from c group by conv_id
"""
