"""Chat formatting with schema fingerprints.

A record's layout is named by a hash of its sorted nested field paths. Each known fingerprint selects a declarative
mapping (where the turns lie, which fields hold role and text, which roles mean what), so prompt/response,
instruction/input/output and message-list layouts all become the same canonical turns. A template then marks the turns;
control strings inside texts are escaped reversibly, and the spans of assistant text form the loss mask.

format_json() takes records of any layout, rows_as_records() makes such of rows by turn: a conversation whose turns fit a
prompt, instruction or question layout is written in one of these (by its id, so that all occur), any other as a list.

Defined cases: a null text is an empty text; a null role becomes the role "null"; rows of one conversation are ordered
by turn (nulls first), ties by role and then text; a conversation without rows doesn't appear; rows with a null
conv_id form one conversation of null id; repeated rows are turns of their own; a text of any length is one turn; an
empty list of turns gives an empty text and mask; a record that is null, no JSON object, nested too deeply to be read (about a
thousand levels), with half a surrogate pair in a text or of an unknown layout has a null text and mask and a problem, which for an
unknown layout names its field paths; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- layouts

ROLES = {"human": "user", "user": "user", "prompter": "user", "gpt": "assistant", "assistant": "assistant", "model": "assistant", "bot": "assistant", "system": "system", "tool": "tool"}


def paths(value, at: str = "") -> set[str]:
    """Nested field paths; all elements of a list share one path."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths(v, f"{at}.{k}" if at else str(k))}
    if isinstance(value, list):
        return {p for v in value for p in paths(v, at + "[]")} or {at + "[]"}
    return {at}


def fingerprint(fields: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(fields)).encode()).hexdigest()[:16]


#: Declarative mappings: a list of turns (list, role, text) or a row of steps (role, fields joined by a blank line).
MAPPINGS = [
    {"fields": ["prompt", "response"], "steps": [("user", ["prompt"]), ("assistant", ["response"])]},
    {"fields": ["prompt", "completion"], "steps": [("user", ["prompt"]), ("assistant", ["completion"])]},
    {"fields": ["system", "prompt", "response"], "steps": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]},
    {"fields": ["question", "answer"], "steps": [("user", ["question"]), ("assistant", ["answer"])]},
    {"fields": ["instruction", "output"], "steps": [("user", ["instruction"]), ("assistant", ["output"])]},
    {"fields": ["instruction", "input", "output"], "steps": [("user", ["instruction", "input"]), ("assistant", ["output"])]},
    {"fields": ["messages[].role", "messages[].content"], "list": "messages", "role": "role", "text": "content"},
    {"fields": ["conversations[].from", "conversations[].value"], "list": "conversations", "role": "from", "text": "value"},
    {"fields": ["turns[].role", "turns[].text"], "list": "turns", "role": "role", "text": "text", "verbatim": True},
]
BY_PRINT = {fingerprint(set(m["fields"])): m for m in MAPPINGS}


EMPTY = {fingerprint({m["list"] + "[]"}): m for m in MAPPINGS if "list" in m}


def canonical(record: dict) -> list[tuple[str, str]]:
    """Canonical turns (role, text) of a record of any known layout."""
    fields = paths(record)
    print_ = fingerprint(fields)
    m = BY_PRINT.get(print_) or EMPTY.get(print_)
    if m is None:
        raise ValueError(f"unknown layout: {sorted(fields)}")
    if "list" in m:
        name = str if m.get("verbatim") else lambda r: ROLES.get(str(r).lower(), str(r).lower())
        return [(name(t.get(m["role"])), str(t.get(m["text"]) or "")) for t in record[m["list"]]]
    return [(role, "\n\n".join(str(record[f]) for f in names if record.get(f))) for role, names in m["steps"]]


# --- template

OPEN, CLOSE, END, ESC = "<|turn|>", "<|text|>", "<|end|>", "\\"
#: Strings that mean something to this or another usual template; inside texts each gets a backslash and a hyphen after its first sign.
CONTROL = [OPEN, CLOSE, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>"]


def escape(text: str) -> str:
    """Doubles backslashes and puts a backslash and a hyphen behind the first sign of each control string, so that none is left whole."""
    text = text.replace(ESC, ESC + ESC)
    for c in CONTROL:
        if c in text:
            text = text.replace(c, c[0] + ESC + "-" + c[1:])
    return text


def unescape(text: str) -> str:
    out, at = [], 0
    while (i := text.find(ESC, at)) >= 0:
        out.append(text[at:i])
        if text[i + 1 : i + 2] == ESC:
            out.append(ESC)
        at = i + 2
    out.append(text[at:])
    return "".join(out)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans (code points) of its assistant texts, the loss mask."""
    out, mask, n = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{CLOSE}", escape(text)
        out += [head, body, END]
        if role == "assistant":
            mask.append((n + len(head), n + len(head) + len(body)))
        n += len(head) + len(body) + len(END)
    return "".join(out), mask


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for piece in formatted.split(OPEN)[1:]:
        role, _, text = piece.partition(CLOSE)
        turns.append((unescape(role), unescape(text[: -len(END)])))
    return turns


#: Layouts in which a conversation of these roles can be written, each a mapping's fields in the order of the turns.
FITTING = {
    ("user", "assistant"): [["prompt", "response"], ["prompt", "completion"], ["question", "answer"], ["instruction", "output"]],
    ("system", "user", "assistant"): [["system", "prompt", "response"]],
}


def record_of(conv_id: int | None, turns: list[tuple[str, str]]) -> dict:
    """A conversation's record in one of the layouts that fit its roles."""
    fitting = FITTING.get(tuple(r for r, _ in turns), [])
    at = (conv_id or 0) % (len(fitting) + 1)
    if at < len(fitting):
        return dict(zip(fitting[at], (t for _, t in turns), strict=True))
    return {"turns": [{"role": r, "text": t} for r, t in turns]}


def rows_as_records(rows: DataFrame) -> DataFrame:
    """conv_id and record (JSON text) of rows (conv_id, turn, role, text)."""

    def run(batches):
        for b in batches:
            out = []
            for cid, turns in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = [("null" if t["role"] is None else t["role"], t["text"] or "") for t in turns]
                out.append(json.dumps(record_of(cid, own), ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["conv_id", "record"])

    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).alias("t"))
    packed = own.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    return packed.mapInArrow(run, "conv_id long, record string")


def format_rows(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, mask (array of start, stop) and problem (null) for rows (conv_id, turn, role, text)."""
    return format_json(rows_as_records(rows))


def formatted_record(record: str | None) -> tuple[str | None, list[int] | None, str | None]:
    """The text, the mask and the problem of a record."""
    try:
        value = json.loads(record) if record is not None else None
        if not isinstance(value, dict):
            return None, None, "no record" if record is None else "not an object"
        text, mask = render(canonical(value))
        text.encode()
    except UnicodeEncodeError:  # JSON can name half a surrogate pair, which no text holds
        return None, None, "half a surrogate pair"
    except RecursionError:
        return None, None, "nested too deeply"
    except ValueError as e:  # not JSON, or an unknown layout
        return None, None, str(e).encode("utf-8", "backslashreplace").decode()
    return text, [x for s in mask for x in s], None


def format_json(records: DataFrame) -> DataFrame:
    """The same of rows (conv_id, record), record a JSON text of any layout."""

    def run(batches):
        for b in batches:
            text, mask, problem = zip(*map(formatted_record, b.column(1).to_pylist()), strict=True) if b.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string()), pa.array(mask, pa.list_(pa.int64())), pa.array(problem, pa.string())], names=["conv_id", "formatted", "mask", "problem"])

    return records.select(F.col("conv_id").cast("long"), F.col("record").cast("string")).mapInArrow(run, "conv_id long, formatted string, mask array<long>, problem string")


def digest(formatted: DataFrame) -> DataFrame:
    """The digest columns, from the formatted texts and masks alone, of records without a problem."""

    def run(batches):
        for b in batches:
            rows = []
            for cid, f, mask in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                turns = read_back(f)
                loss = "".join(unescape(f[mask[i] : mask[i + 1]]) for i in range(0, len(mask), 2))
                whole = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((cid, len(turns), whole, len(loss), hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(f)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.where("formatted is not null").select("conv_id", "formatted", "mask").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
