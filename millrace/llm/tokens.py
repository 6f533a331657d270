"""Token ids of whole texts by public vocabularies; equal chunks of a run of texts are encoded once.

Both kinds of vocabulary split a text into pieces before merging, and no piece reaches over the start
of a run of white space, so a text's ids are its chunks' ids in a row. Arrow splits a run of texts at its
single spaces and finds the distinct chunks, and the tokenizers library encodes those, thousands in one
text whose ids are cut where a chunk begins or ends. Nothing is kept from one run to the next. Texts whose white space such a cut could change (longer runs, rare characters) are cut by a pattern
instead, and texts that hold a special token's string go through the library whole, as it treats those.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


# Fixed value: the characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: White space that a cut at every space and line end would change: other characters, runs of three, runs of two at the end.
_UNEVEN = r"[\t\x{0b}-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n]{3}|[ \n]{2}\z"
#: Fixed value: marks that often end a chunk; after a letter they are always pieces of their own.
ENDINGS = ".,;:!?"
#: Chunks put together in one string; strings encoded at a time; bytes of text whose chunks are encoded together.
JOINED, AT_ONCE, RUN_BYTES = 500, 5_000, 12 << 20


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen runs of ``flat`` in a row, and their lengths."""
    length = lengths[chosen]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int32 if total < 1 << 30 and len(flat) < 1 << 30 else np.int64)
    at += np.repeat((starts[chosen] - (ends - length)).astype(at.dtype), length)
    return flat[at], length


class _Runs:
    """Runs of ids, collected one batch after another; the first run is empty."""

    def __init__(self):
        self.ids, self.lengths, self.n = [np.zeros(0, dtype=np.uint32)], [np.zeros(1, dtype=np.int64)], 1

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of the added runs."""
        self.ids.append(ids)
        self.lengths.append(lengths)
        self.n += len(lengths)
        return np.arange(self.n - len(lengths), self.n)

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.concatenate(self.lengths)
        return np.concatenate(self.ids), np.cumsum(lengths) - lengths, lengths


class Encoder:
    """Ids of texts by a vocabulary file of the tokenizers library, as its ``encode`` without added special tokens gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that the library takes for one id wherever they stand.
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Whether the vocabulary ignores white space and the case of ASCII letters.
        self.folds = self.whole(" Aa  B") == self.whole("aa b")
        # Each chunk of a joined text begins or ends at ids that can be told by their strings.
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.borders = np.array([n.endswith("</w>") if self.folds else n[:1] in ("Ġ", "Ċ") for n in names])

    def whole(self, text: str) -> list[int]:
        """Ids of a text by the library alone."""
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _each(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some strings in a row and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(lengths.sum())), lengths

    def _joined(self, runs: _Runs, chunks: pa.Array, before: str) -> np.ndarray:
        """Numbers of runs for chunks that are one text when put together with ``before`` in front of each."""
        cuts = np.append(np.arange(0, len(chunks), JOINED), len(chunks)).astype(np.int32)
        numbers = [np.zeros(0, dtype=np.int64)]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), chunks), before).to_pylist() if len(chunks) else []
        for k, text in enumerate(texts):
            (found,) = self.tokenizer.encode_batch_fast([before + text], add_special_tokens=False)
            ids = np.array(found.ids, dtype=np.uint32)
            ends = np.flatnonzero(self.borders[ids])
            ends = np.concatenate([[0], ends + 1]) if self.folds else np.append(ends, len(ids))
            if len(ends) == cuts[k + 1] - cuts[k] + 1 and ends[0] == 0 and ends[-1] == len(ids):
                numbers.append(runs.add(ids, np.diff(ends)))
            else:
                numbers.append(self._add(runs, [before + c for c in chunks[cuts[k] : cuts[k + 1]].to_pylist()]))
        return np.concatenate(numbers)

    def _add(self, runs: _Runs, some: list[str]) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype=np.int64), *(runs.add(*self._each(some[a : a + AT_ONCE])) for a in range(0, len(some), AT_ONCE))])

    def _chunks(self, runs: _Runs, names: pa.Array) -> np.ndarray:
        """Two runs of each of some distinct chunks, which have a space before them if the vocabulary minds: words of letters
        and the marks after them, or the whole chunk and nothing."""
        cores = pc.utf8_rtrim(names, characters=ENDINGS)
        plain = pc.utf8_is_alpha(cores).to_numpy(zero_copy_only=False)
        pairs = np.zeros((len(names), 2), dtype=np.int64)
        coded = cores.filter(pa.array(plain)).dictionary_encode()
        pairs[plain, 0] = self._joined(runs, coded.dictionary, " ")[coded.indices.to_numpy()]
        marks = pc.binary_length(names).to_numpy() - pc.binary_length(cores).to_numpy()
        for size in np.unique(marks[plain & (marks > 0)]).tolist():
            marked = np.flatnonzero(plain & (marks == size))
            coded = pc.utf8_slice_codeunits(names.take(pa.array(marked)), start=-size, stop=None).dictionary_encode()
            pairs[marked, 1] = self._add(runs, coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        if self.folds:
            pairs[~plain, 0] = self._add(runs, names.filter(pa.array(~plain)).to_pylist())
            return pairs
        # Chunks that are white space would run into the next one, and a line end takes the place of a space.
        line = pc.starts_with(names, "\n").to_numpy(zero_copy_only=False)
        bare = pc.binary_length(names).to_numpy() - line == 0
        for some, before in ((~plain & ~bare & ~line, " "), (~plain & ~bare & line, "")):
            pairs[some, 0] = self._joined(runs, names.filter(pa.array(some)), before)
        pairs[bare, 0] = self._add(runs, [n or " " for n in names.filter(pa.array(bare)).to_pylist()])
        return pairs

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row as unsigned 32-bit integers, ids of each text); a null text has none."""
        special = np.zeros(len(texts), dtype=bool)
        for name in self.specials:
            special |= pc.fill_null(pc.match_substring(texts, name), False).to_numpy(zero_copy_only=False)
        odd = special.copy()
        if not self.folds:
            odd |= pc.fill_null(pc.match_substring_regex(texts, _UNEVEN), False).to_numpy(zero_copy_only=False)
        even = texts if not odd.any() else texts.filter(pa.array(~odd))
        even = pc.replace_substring(pc.ascii_lower(even), "\n", " ") if self.folds else pc.replace_substring(even, "\n", " \n")
        lists = pc.split_pattern(even, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        chosen, counts = coded.indices.to_numpy().astype(np.int64), np.diff(offsets)
        runs = _Runs()
        pairs = self._chunks(runs, coded.dictionary)
        if not self.folds:
            # A text's first chunk has no space before it.
            first = offsets[:-1][counts > 0]
            known, at = np.unique(chosen[first], return_inverse=True)
            more = self._add(runs, coded.dictionary.take(pa.array(known)).to_pylist())
            chosen[first] = len(pairs) + at
            pairs = np.concatenate([pairs, np.stack([more, np.zeros_like(more)], axis=1)])
        if odd.any():
            cut = [[t] if s else _CHUNK.findall(t) for t, s in zip(texts.filter(pa.array(odd)).to_pylist(), special[odd])]
            known = {c: k for k, c in enumerate(dict.fromkeys(chain.from_iterable(cut)))}
            more = self._add(runs, list(known))
            aside = iter([np.array([known[c] for c in chunks], dtype=np.int64) + len(pairs) for chunks in cut])
            pairs = np.concatenate([pairs, np.stack([more, np.zeros_like(more)], axis=1)])
            rest = iter(np.split(chosen, offsets[1:-1]) if len(counts) else [])
            mixed = [next(aside if o else rest) for o in odd]
            chosen, counts = np.concatenate(mixed), np.array(list(map(len, mixed)), dtype=np.int64)
        flat, lengths = _gather(*runs.table(), pairs.ravel())
        per_chunk = lengths.reshape(-1, 2).sum(axis=1)
        ids, lengths = _gather(flat, np.cumsum(per_chunk) - per_chunk, per_chunk, chosen)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(ends)


_encoders: dict[str, Encoder] = {}


def worker_encoder(path: str) -> Encoder:
    """The encoder of this worker process, which its tasks share."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
