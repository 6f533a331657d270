"""Encoding and decoding by a SentencePiece vocabulary of the merge type, exactly as its library does it.

Merging joins the best pair of neighbours of a text, time and again. A sequence of pieces is the outcome if
and only if each two neighbours are compatible: merging the text of both gives just these two. So a text is encoded
from left to right: the longest piece that starts at a place (an Aho-Corasick automaton finds all of them)
and is compatible with the one before it is taken; where there is none, the last piece is taken back, its
end is marked as failed in a bitfield, and a shorter one is tried. No place fails twice. Compatibility is found by
merging the two pieces' text once more, and remembered.

Pieces never reach over a pair of characters that no piece of the vocabulary holds, so a text is cut there; of
a batch, the distinct parts are encoded. A character without a piece becomes the pieces of its bytes.
Memories of compatible pairs and of encoded parts are bounded and emptied when they are full, which changes no result.

Defined cases: a null or empty text has no pieces and is decoded as an empty text; special strings
(``<s>``) inside a text are ordinary characters; null and repeated ids are rows like any other; extra columns are ignored; an
empty table gives an empty result; a text of any length is handled whole. A vocabulary that
normalises texts or has pieces set by its user is refused, since its library treats those in other ways.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_runs, trim, tune
from .tokens import _gather, vocabulary_path

#: Fixed value: the character that stands for a space in pieces.
SPACE = "▁"
#: Bytes of text encoded together; pairs and parts that a worker remembers; longest part that it remembers, in characters.
RUN_BYTES, PAIRS, PARTS, PART_CHARS = 6 << 20, 1 << 20, 1 << 18, 32
#: Characters below this number are told apart by a table of pairs.
NEAR = 0x250

ENCODED_SCHEMA = "doc_id long, ids array<int>"
DECODED_SCHEMA = "doc_id long, decoded string"
BOTH_SCHEMA = "doc_id long, ids array<int>, decoded string"


class Codec:
    """The pieces of a model file, with what encoding and decoding need."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = len(model)
        names = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(n)]
        # A test string of what normalisers change: spaces at the ends and in a row, compatibility characters, marks.
        probe = "  Ａ  ﬁ é \t"
        if any(model.is_unused(i) for i in range(n)) or model.decode(model.encode(probe)) != probe or model.encode("a", out_type=str)[0][:1] != SPACE:
            raise ValueError("the vocabulary normalises texts or has pieces out of use")
        #: The id of each byte, by which characters without a piece are encoded.
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no piece for some bytes")
        self.names = names
        self.ids = {names[i]: i for i in range(n) if not special[i] and not model.is_byte(i)}
        self.scores = {name: model.get_score(i) for name, i in self.ids.items()}
        self.single = {name for name in self.ids if len(name) == 1}
        self.automaton = ahocorasick.Automaton()
        for name, i in self.ids.items():
            # A piece that merging its own characters doesn't give never occurs in a result.
            if len(name) == 1 or self.merge(name) == [name]:
                self.automaton.add_word(name, (len(name), i))
        self.automaton.make_automaton()
        #: The next shorter piece that starts where a piece does, if any.
        self.shorter = {}
        for length, i in self.automaton.values():
            name = names[i]
            prefix = next((name[:k] for k in range(length - 1, 0, -1) if name[:k] in self.automaton), None)
            if prefix:
                self.shorter[i] = self.automaton.get(prefix)
            elif name[0] not in self.single:
                self.shorter[i] = (1, ~ord(name[0]))
        pairs = {(ord(a), ord(b)) for name in self.ids for a, b in zip(name, name[1:])}
        self.near = np.zeros((NEAR, NEAR), dtype=bool)
        code = lambda c: NEAR - 1 if c == ord(SPACE) else c
        for a, b in pairs:
            if code(a) < NEAR and code(b) < NEAR:
                self.near[code(a), code(b)] = True
        self.far = np.array(sorted((a << 21) | b for a, b in pairs), dtype=np.int64)
        surfaces = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else bytes([int(names[i][3:5], 16)]) if model.is_byte(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        self.surface_lengths = np.array(list(map(len, surfaces)), dtype=np.int64)
        self.surface_starts = np.cumsum(self.surface_lengths) - self.surface_lengths
        self.surfaces = np.frombuffer(b"".join(surfaces), dtype=np.uint8)
        self.opens = np.array([name[:1] == SPACE for name in names])
        self.controls = np.array([model.is_control(i) for i in range(n)])
        self.pairs: dict[tuple[int, int], bool] = {}
        self.recent: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def merge(self, text: str) -> list[str]:
        """Merge the pair of neighbours with the best score, the leftmost of equal ones, until none is left."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def text_of(self, piece: int) -> str:
        """The text of a piece, or of a character without one, whose number is negative."""
        return self.names[piece] if piece >= 0 else chr(~piece)

    def compatible(self, one: int, two: int) -> bool:
        """Whether merging the text of both pieces keeps them apart."""
        found = self.pairs.get((one, two))
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            a, b = self.text_of(one), self.text_of(two)
            found = self.pairs[one, two] = self.merge(a + b) == [a, b]
        return found

    def encode_part(self, part: str) -> list[int]:
        """Ids of a part of a text, by backtracking."""
        n, memory, shorter = len(part), self.pairs, self.shorter
        longest: list[tuple[int, int] | None] = [None] * n
        if not self.single.issuperset(part):
            for k, c in enumerate(part):
                if c not in self.single:
                    longest[k] = (1, ~ord(c))
        # Of the matches that start at a place the one that ends last stays.
        for last, match in self.automaton.iter(part):
            longest[last + 1 - match[0]] = match
        failed = 0
        pieces: list[int] = []
        starts: list[int] = []
        at, match = 0, longest[0]
        while at < n:
            if match is None:
                failed |= 1 << at
                match, at = shorter.get(pieces.pop()), starts.pop()
                continue
            length, piece = match
            end = at + length
            fits = not (failed and failed >> end & 1)
            if fits and pieces:
                fits = memory.get((pieces[-1], piece))
                if fits is None:
                    fits = self.compatible(pieces[-1], piece)
            if fits:
                pieces.append(piece)
                starts.append(at)
                at = end
                match = longest[at] if at < n else None
            else:
                match = shorter.get(piece)
        return pieces if min(pieces) >= 0 else [i for p in pieces for i in ([p] if p >= 0 else [self.bytes[b] for b in chr(~p).encode()])]

    def encode_parts(self, parts: list[str]) -> list[list[int]]:
        """Ids of some distinct parts. Those of the last runs are remembered in two halves, of which the older one is forgotten first."""
        out, recent, older = [], self.recent, self.older
        for part in parts:
            ids = recent.get(part)
            if ids is None:
                ids = older.get(part)
                if ids is None:
                    ids = tuple(self.encode_part(part))
                if len(part) <= PART_CHARS:
                    if len(recent) >= PARTS // 2:
                        older = self.older = recent
                        recent = self.recent = {}
                    recent[part] = ids
            out.append(ids)
        return out

    def _cuts(self, codes: np.ndarray) -> np.ndarray:
        """For each pair of neighbouring characters whether no piece holds it."""
        short = np.where(codes == ord(SPACE), NEAR - 1, np.minimum(codes, NEAR)).astype(np.int32)
        # The table's last character is the space's; a real one of that number, and all above, are looked up.
        odd = (short == NEAR) | (codes == NEAR - 1)
        cut = ~self.near[np.minimum(short[:-1], NEAR - 1), np.minimum(short[1:], NEAR - 1)]
        far = np.flatnonzero(odd[:-1] | odd[1:])
        if len(far):
            keys = (codes[far].astype(np.int64) << 21) | codes[far + 1]
            at = np.minimum(np.searchsorted(self.far, keys), len(self.far) - 1)
            cut[far] = self.far[at] != keys
        return cut

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids of each text)."""
        texts = pc.fill_null(texts, "")
        bare = pc.binary_length(texts).to_numpy() == 0
        lead = pa.array(np.where(bare, "", SPACE))
        texts = pc.binary_join_element_wise(lead, pc.replace_substring(texts, " ", SPACE), "")
        lengths = pc.binary_length(texts).to_numpy().astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        data = "".join(texts.to_pylist()).encode()
        if not data:
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        codes = np.frombuffer(data.decode().encode("utf-32-le"), dtype="<u4")
        width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width)])
        cut = np.concatenate([[True], self._cuts(codes)])
        first = np.searchsorted(place, begins[~bare])
        cut[first] = True
        starts = place[np.flatnonzero(cut)]
        offsets = np.append(starts, len(data)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        found = self.encode_parts(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(sizes.sum()))
        ids, per_part = _gather(flat, np.cumsum(sizes) - sizes, sizes, coded.indices.to_numpy())
        before = np.concatenate([[0], np.cumsum(per_part)])
        at = np.searchsorted(starts, np.append(begins, len(data)))
        return ids, np.diff(before[at])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of some sequences of ids, which follow each other in ``ids``.

        Bytes that are no UTF-8 each become the replacement character; the space that a sequence's first piece begins with is
        the one that encoding put there, and is dropped.
        """
        data, lengths = _gather(self.surfaces, self.surface_starts, self.surface_lengths, ids)
        ends = np.cumsum(counts)
        before = np.concatenate([[0], np.cumsum(lengths)])
        begins, closes = before[ends - counts], before[ends]
        some = np.flatnonzero(counts)
        opens = self.opens[ids[(ends - counts)[some]]]
        keep = np.ones(len(data), dtype=bool)
        keep[begins[some][opens]] = False
        begins[some] += opens
        offsets = np.concatenate([[0], np.cumsum(closes - begins)]).astype(np.int32)
        out = pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets), pa.py_buffer(data[keep].tobytes()))
        try:
            if self.controls[ids].any():
                raise pa.ArrowInvalid("controls part bytes")
            out.validate(full=True)
        except pa.ArrowInvalid:
            out = pa.array([self._decode_oddly(row) for row in np.split(ids, ends[:-1])] if len(counts) else [], pa.string())
        return out

    def _decode_oddly(self, ids: np.ndarray) -> str:
        """The text of a sequence that may hold controls, which are nothing but part bytes, or bytes that make no character."""
        runs = np.split(ids, np.flatnonzero(self.controls[ids]))
        runs = [r for r in (r[self.controls[r].sum() :] for r in runs) if len(r)]
        texts = [_forgiving(_gather(self.surfaces, self.surface_starts, self.surface_lengths, r)[0].tobytes()) for r in runs]
        if texts and self.opens[runs[0][0]]:
            texts[0] = texts[0][1:]
        return "".join(texts)


def _forgiving(data: bytes) -> str:
    """The text of some bytes; each byte that is no part of a character becomes the replacement character."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as e:
            out += [data[: e.start].decode(), "�"]
            data = data[e.start + 1 :]
    return "".join(out)


_codecs: dict[str, Codec] = {}


def worker_codec(path: str) -> Codec:
    """The codec of this worker process, which its tasks share."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return lists.flatten().to_numpy(zero_copy_only=False), pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)


def encode(docs: DataFrame, vocabulary: str | None = None, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every row (doc_id, text): one pass, without a shuffle.

    ``decoded`` adds the text that the ids are decoded to, in the same pass.
    """
    path = vocabulary or vocabulary_path("piece_bpe_32k.model")
    tune(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path)
        for batch in text_runs(batches, RUN_BYTES):
            ids, counts = codec.encode(batch.column("text"))
            columns = {"doc_id": batch.column("doc_id").cast(pa.int64()), "ids": _lists(ids, counts)}
            if decoded:
                columns["decoded"] = codec.decode(ids, counts)
            yield pa.RecordBatch.from_pydict(columns)
        trim()

    return docs.select("doc_id", "text").mapInArrow(work, BOTH_SCHEMA if decoded else ENCODED_SCHEMA)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, decoded) of every row (doc_id, ids); null ids are an empty text."""
    path = vocabulary or vocabulary_path("piece_bpe_32k.model")
    tune(encoded.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path)
        for batch in batches:
            texts = codec.decode(*_flat(batch.column("ids")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), texts], names=["doc_id", "decoded"])

    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(work, DECODED_SCHEMA)


def digests(both: DataFrame) -> DataFrame:
    """Digests of ids and of decoded texts."""
    ids = F.sha2(F.array_join("ids", ","), 256)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
