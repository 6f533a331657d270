"""Chat formatting by schema fingerprints.

Records of conversations come in many layouts. The nested field paths of a record are hashed to a
fingerprint; a registry of declarative mappings, keyed by fingerprint, says where its turns are. The
turns are then written with one template whose control strings are escaped inside texts, so that the
output can be read back exactly.

Defined cases: null texts and roles are empty; rows of a conversation with equal ``turn`` are ordered
by role and text, and repeated rows are repeated turns; rows with a null conversation id form one
conversation with a null id; a null ``turn`` sorts first; extra columns are ignored; an empty table
gives an empty result; texts may be of any length. A record whose fingerprint has no mapping, as when a number
stands for a text or an item lacks a field, gives ``turns`` null in :func:`canonical_turns`, so nothing is
lost silently.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune

# Strings that steer a model in common chat templates; escaped wherever a text holds them.
CONTROL_STRINGS = (
    "<|turn|>", "<|text|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
    "<|begin_of_text|>", "<|eot_id|>", "<|start_header_id|>", "<|end_header_id|>",
    "<|user|>", "<|assistant|>", "<|system|>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "<bos>", "<eos>", "<pad>", "<unk>",
    "<start_of_turn>", "<end_of_turn>",
)
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"

#: A control string with any number of backslashes after its first character.
_ESCAPABLE = re.compile("|".join(rf"{re.escape(s[0])}\\*{re.escape(s[1:])}" for s in CONTROL_STRINGS))
_ESCAPED = re.compile("|".join(rf"{re.escape(s[0])}\\+{re.escape(s[1:])}" for s in CONTROL_STRINGS))


def escape(text: str) -> str:
    """One backslash more after the first character of every control string, however many it has."""
    return _ESCAPABLE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """The inverse of :func:`escape`."""
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def field_paths(value, prefix: str = "") -> set[str]:
    """Nested field paths of a record with the kind of each leaf; null counts as text.

    Every layout that occurs among a list's items is one path, so items that lack a field aren't hidden by others.
    """
    if isinstance(value, dict):
        return set().union({f"{prefix}{{}}"}, *(field_paths(v, f"{prefix}.{k}") for k, v in value.items()))
    if isinstance(value, list):
        return {f"{prefix}[]"} | {f"{prefix}[{fingerprint(field_paths(v))}]" for v in value}
    return {f"{prefix}:{'text' if value is None or isinstance(value, str) else type(value).__name__}"}


def fingerprint(paths: set[str]) -> str:
    """Hash of a layout: 16 hex digits over the sorted field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


#: Declarative mappings. example: a record that shows all fields; optional: fields that may be missing;
#: pairs: (role, fields) in order; list: a list field and the names of role and text in its items, which
#: follow the pairs; roles: whether the layout has its own role names.
MAPPINGS = (
    {"name": "messages", "example": {"messages": [{"role": "", "content": ""}]}, "optional": [], "list": ("messages", "role", "content")},
    {"name": "turn_rows", "example": {"turns": [{"role": "", "text": ""}]}, "optional": [], "list": ("turns", "role", "text")},
    {"name": "sharegpt", "example": {"system": "", "conversations": [{"from": "", "value": ""}]}, "optional": ["system"], "list": ("conversations", "from", "value"), "roles": True, "pairs": [("system", ["system"])]},
    {"name": "prompt", "example": {"system": "", "prompt": "", "completion": ""}, "optional": ["system"], "pairs": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["completion"])]},
    {"name": "prompt_response", "example": {"system": "", "prompt": "", "response": ""}, "optional": ["system"], "pairs": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]},
    {"name": "instruction", "example": {"system": "", "instruction": "", "input": "", "output": ""}, "optional": ["system", "input"], "pairs": [("system", ["system"]), ("user", ["instruction", "input"]), ("assistant", ["output"])]},
    {"name": "question", "example": {"context": "", "question": "", "answer": ""}, "optional": ["context"], "pairs": [("system", ["context"]), ("user", ["question"]), ("assistant", ["answer"])]},
)

#: Role names of other layouts and what they mean here.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


def registry() -> dict[str, dict]:
    """Fingerprint to mapping, for every choice of optional fields and for empty turn lists."""
    found: dict[str, dict] = {}
    for m in MAPPINGS:
        must = [k for k in m["example"] if k not in m["optional"]]
        for mask in range(1 << len(m["optional"])):
            keys = must + [k for i, k in enumerate(m["optional"]) if mask >> i & 1]
            record = {k: m["example"][k] for k in keys}
            for shape in (record, {k: [] if isinstance(v, list) else v for k, v in record.items()}):
                found.setdefault(fingerprint(field_paths(shape)), m)
    return found


def turns_of(record: dict, mapping: dict) -> list[tuple[str, str]]:
    """Canonical (role, text) turns of a record under a mapping."""
    turns = []
    for role, fields in mapping.get("pairs", []):
        parts = [record[f] or "" for f in fields if f in record]
        parts = [p for i, p in enumerate(parts) if p or i == 0]
        if parts:
            turns.append((role, "\n\n".join(parts)))
    if "list" in mapping:
        name, role, text = mapping["list"]
        names = ROLE_NAMES if mapping.get("roles") else {}
        turns += [(names.get(x[role] or "", x[role] or ""), x[text] or "") for x in record[name]]
    return turns


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans (code points) of its assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for piece in formatted.split(END)[:-1]:
        role, _, text = piece.removeprefix(TURN).partition(TEXT)
        turns.append((unescape(role), unescape(text)))
    return turns


def canonical_turns(record: str | None, known: dict[str, dict]) -> tuple[str | None, list[tuple[str, str]] | None]:
    """(layout name, turns) of a JSON record; (None, None) if its layout has no mapping, it isn't JSON, it is nested too deep
    to be walked through, or its names or texts hold half a surrogate pair, which no text can be written with."""
    try:
        value = json.loads(record or "")
        mapping = known.get(fingerprint(field_paths(value))) if isinstance(value, dict) else None
        turns = turns_of(value, mapping) if mapping else None
        for turn in turns or []:
            "".join(turn).encode()
    except (ValueError, RecursionError):
        return None, None
    return (mapping["name"], turns) if mapping else (None, None)


FORMAT_SCHEMA = "conv_id long, layout string, formatted string, loss_spans array<struct<begin: long, end: long>>"


def format_records(records: DataFrame) -> DataFrame:
    """Format JSON records (conv_id, record): layout, formatted text and the spans that bear loss.

    ``layout`` and ``formatted`` are null where no mapping fits.
    """
    tune(records.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = registry()
        for batch in batches:
            layouts, texts, spans = [], [], []
            for record in batch["record"]:
                layout, turns = canonical_turns(record, known)
                text, found = render(turns) if turns is not None else (None, [])
                layouts.append(layout)
                texts.append(text)
                spans.append([{"begin": a, "end": b} for a, b in found])
            ids = batch["conv_id"].astype("Int64")
            yield pd.DataFrame({"conv_id": ids, "layout": layouts, "formatted": texts, "loss_spans": spans})

    return records.select("conv_id", "record").mapInPandas(run, FORMAT_SCHEMA)


def records_from_rows(rows: DataFrame) -> DataFrame:
    """One JSON record per conversation from one row per turn (conv_id, turn, role, text).

    A conversation is one training example and becomes one string, so its turns have to meet in one row.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.groupBy("conv_id").agg(F.to_json(F.struct(turns.alias("turns"))).alias("record"))


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations finds in them: turns, masked text and sizes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch["formatted"], batch["loss_spans"]):
                turns = parse(text or "")
                loss = "".join(unescape(text[s["begin"] : s["end"]]) for s in spans)
                all_turns = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                rows.append((len(turns), all_turns, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text or "")))
            out = pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            out.insert(0, "conv_id", batch["conv_id"].astype("Int64").to_numpy())
            yield out

    return formatted.mapInPandas(run, DIGEST_SCHEMA)
