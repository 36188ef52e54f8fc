"""Token ids of whole texts: the tokenizers library on distinct chunks, numpy for the rest.

Both public byte-pair vocabularies split a text before they merge, and no piece holds a single space or line feed
between two characters that are no white space, unless it begins with it.  So a text cut before these gives the same ids, chunk by chunk,
as the whole text does, and a worker asks the library once for each distinct chunk it has not met.

A chunk of letters is one piece of its own.  So many of them are asked for as one text, which spares the library's
cost of a call's result per chunk; its ids are cut again at the tokens that begin (or end) a piece.
"""

from __future__ import annotations

import json
import os
import re
import string
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ADJACENT = re.compile(r"\s\s")
_SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_FOREIGN = re.compile("[^\\x00-\u012f\u0131-\u024f]")  # beyond: characters that combine, or lower-case in more than one way
_STOPS = string.punctuation
_JOINED = 512  # chunks asked for as one text
_ENCODERS: dict[str, ChunkEncoder] = {}


def _uneven(text: str) -> bool:
    """Whether some white space stands beside other white space or a text's end."""
    return bool(text) and (text[0].isspace() or text[-1].isspace() or _ADJACENT.search(text) is not None)


def chunks(text: str) -> list[str]:
    """Cut a text before each single space or line feed that stands between two visible characters."""
    if not text:
        return []
    if "\0" in text or _uneven(text):
        return _SAFE_CUT.split(text)
    return _marked(text).split("\0")


def _marked(text: str) -> str:
    return text.replace(" ", "\0 ").replace("\n", "\0\n")


class ChunkEncoder:
    """Ids of texts through one tokenizer file; remembers at most ``max_chunks`` chunks, the often used ones longest."""

    def __init__(self, path: str, max_chunks: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ending = model.get("end_of_word_suffix") or ""
        self.edge = np.zeros(max(model["vocab"].values()) + 1, bool)  # tokens that end a piece, or that begin one with white space
        self.edge[[i for t, i in model["vocab"].items() if (t.endswith(ending) if ending else t[0] in "\u0120\u010a")]] = True
        self.at_end = bool(ending)
        self.folds = bool(ending) and self._plain(["A"])[0] == self._plain(["a"])[0]
        self.letters = Tokenizer.from_file(path)  # for joined chunks
        if self.folds:  # these are lower-cased and hold nothing else that a normaliser changes
            self.letters.normalizer = normalizers.Sequence([])
        self.max_chunks = max_chunks
        self.known: dict[str, int] = {}
        self.names = pa.array([], pa.large_string())  # the same chunks in an array
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _trim(self) -> None:
        """Forget chunks used once, or more if half of the room would stay taken."""
        least = max(2, int(np.partition(self.uses, -(self.max_chunks // 2))[-(self.max_chunks // 2)]) + 1) if len(
            self.uses
        ) > self.max_chunks // 2 else 2
        keep = self.uses >= least
        place = np.cumsum(keep) - 1
        self.names = self.names.filter(pa.array(keep))
        self.known = {c: int(place[k]) for c, k in self.known.items() if keep[k]}
        ids, at = self._ids(np.flatnonzero(keep))
        self.flat, self.starts, self.lengths = ids, at[:-1], np.diff(at)
        self.uses = self.uses[keep] // 2

    def _ids(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known chunks one after another, and where each begins (with a last end)."""
        lengths = self.lengths[which]
        at = np.concatenate([[0], np.cumsum(lengths)])
        place = np.repeat(self.starts[which] - at[:-1], lengths) + np.arange(at[-1])
        return self.flat[place], at

    def _add(self, new: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.known)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        self.flat = np.concatenate([self.flat, ids])
        self.known.update(zip(new, range(first, first + len(new))))
        self.names = pa.concat_arrays([self.names, pa.array(new, pa.large_string())])

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, asked: list[str]) -> list[list[int]]:
        texts = ("".join(asked[i : i + _JOINED]) for i in range(0, len(asked), _JOINED))
        texts = [t.lower() if self.folds else t for t in texts]
        return [e.ids for e in self.letters.encode_batch_fast(texts, add_special_tokens=False)]

    def _ask(self, asked: list[str], lettered: bool) -> None:
        """Learn chunks; ``lettered`` ones are white space and a run of letters each, and are asked for together."""
        if lettered:
            found = self._joined(asked)
            ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) == len(asked):
                self._add(asked, ids, np.diff(edges, prepend=-1) if self.at_end else np.diff(edges, append=len(ids)))
                return
        found = self._plain(asked)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self._add(asked, np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths)

    def _learn(self, new: list[str]) -> None:
        parts, lettered, others = {}, {}, {}
        for chunk in new:  # a split stands between a letter and a full stop or the like in either vocabulary
            core = chunk.rstrip(_STOPS)
            if core and core[-1].isalpha() and core[-1] < "\u0250":
                if len(core) < len(chunk):
                    stops = chunk[len(core) :]
                    parts[chunk] = (core, stops)
                    if stops not in self.known:
                        others[stops] = None
                    if core in self.known:
                        continue
                if core[0] in " \n" and core[1:].isalpha() and (core.isascii() or not _FOREIGN.search(core)):
                    lettered[core] = None
                else:
                    others[core] = None
            else:
                others[chunk] = None
        self._ask(list(lettered), True)
        self._ask(list(others), False)
        both = np.array([self.known[c] for pair in parts.values() for c in pair], np.int64)
        ids, at = self._ids(both)
        self._add(list(parts), ids, np.diff(at[::2]))

    def _pieces(self, texts: list[str | None]) -> tuple[pa.Array, list[int]]:
        """Chunks of all texts in one array, and how many each text has."""
        texts = [t or "" for t in texts]
        if self.folds:
            texts = [t.lower() if t.isascii() or not _FOREIGN.search(t) else t for t in texts]
        if any("\0" in t for t in texts):
            own = [chunks(t) for t in texts]
            return pa.array(list(chain.from_iterable(own)), pa.large_string()), [len(c) for c in own]
        marked = ["\0".join(chunks(t)) if _uneven(t) else _marked(t) for t in texts]
        whole = pa.array(["\0".join(filter(None, marked))], pa.large_string())
        cut = pc.split_pattern(whole, "\0").values if whole[0].as_py() else whole[:0]
        return cut, [t.count("\0") + 1 if t else 0 for t in marked]

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Numbers of known chunks, -1 for others."""
        return pc.index_in(pieces, value_set=self.names).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def encode(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text starts (with a last end)."""
        pieces, counts = self._pieces(texts)
        which = self._places(pieces)
        missing = np.flatnonzero(which < 0)
        if len(missing):
            coded = pieces.take(pa.array(missing)).dictionary_encode()
            if len(self.known) + 2 * len(coded.dictionary) > self.max_chunks and self.known:
                self._trim()
                which = self._places(pieces)
                missing = np.flatnonzero(which < 0)
                coded = pieces.take(pa.array(missing)).dictionary_encode()
            new = coded.dictionary.to_pylist()
            self._learn(new)
            which[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))[coded.indices.to_numpy()]
        self.uses += np.bincount(which, minlength=len(self.uses))
        ids, at = self._ids(which)
        offsets = at[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        if end_id is not None:
            ids = np.insert(ids, offsets[1:], end_id)
            offsets = offsets + np.arange(len(offsets))
        return ids, offsets


def encoder(path: str) -> ChunkEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]
