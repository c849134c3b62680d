"""Token ids of whole texts through the tokenizers library, word by word.

The vocabulary's pre-tokenizer never joins characters across white space, nor
an ASCII letter or digit with a following ``. , ; : ! ?``, so the ids of a text
are those of its pieces in order.  A task encodes each distinct piece once and
puts texts together with numpy; words stay known to the Python worker between
tasks, up to ``MAX_KNOWN`` of them.  A text that spells a special token is encoded
whole.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import vectors as V

#: Distinct words that a Python worker remembers before it starts afresh.
MAX_KNOWN = 1 << 19
#: Lower-case words of Latin letters, one piece each and unchanged by the
#: normaliser: the model is asked directly.
PLAIN = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE shows for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain}
    shown.update({b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in shown)})
    return shown


class Encoder:
    """Encodes Arrow columns of texts; one per vocabulary and Python worker."""

    _kept: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._letters = _byte_letters()
        self._forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    @classmethod
    def release(cls) -> None:
        """Drop what this worker remembers: for tasks of another kind, which
        need the memory, after those that encode."""
        cls._kept.clear()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(1 << 18, np.int64)

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        model, letters = self.library.model, self._letters
        plain = V.values(pc.match_substring_regex(pa.array(words, pa.large_string()), PLAIN))
        out: list[list[int]] = [[]] * len(words)
        others = []
        for k, (w, simple) in enumerate(zip(words, plain, strict=True)):
            if simple:
                shown = w if w.isascii() else w.encode().decode("latin-1").translate(letters)
                out[k] = [t.id for t in model.tokenize(shown)]
            else:
                others.append(k)
        if others:
            found = self.library.encode_batch([words[k] for k in others], add_special_tokens=False)
            for k, e in zip(others, found, strict=True):
                out[k] = e.ids
        return out

    def _learn(self, words: list[str]) -> None:
        first = len(self.known)
        found = self._encode_words(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        start = int(self.ends[first - 1]) if first else 0
        ends = start + np.cumsum(sizes)
        total, count = int(ends[-1]), first + len(words)
        if total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), total - len(self.ids)), np.uint32)])
        if count > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(max(len(self.ends), count - len(self.ends)), np.int64)])
        self.ids[start:total] = np.fromiter(chain.from_iterable(found), np.uint32, total - start)
        self.ends[first:count] = ends
        self.known.update(zip(words, range(first, count), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids uint32, offsets of each text) of a column; null is empty."""
        texts = V.rebased(texts)
        odd = np.zeros(len(texts), bool)
        for token in self.special:
            odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        spaced = pc.replace_substring_regex(pc.ascii_lower(plain), r"([a-z0-9])([.,;:!?])", r"\1 \2")
        pieces = pc.ascii_split_whitespace(spaced)
        bounds = pieces.offsets.to_numpy().astype(np.int64)
        coded = pieces.flatten().dictionary_encode()
        unique = V.values(coded.dictionary)
        if len(self.known) + len(unique) > MAX_KNOWN:
            self._forget()
        # in order of appearance, unknown words get the next places
        place = np.array([self.known.get(w, -1) for w in unique], np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = np.arange(len(new)) + len(self.known)
            self._learn([unique[i] for i in new.tolist()])
        ends = self.ends[place]
        starts = np.where(place > 0, self.ends[place - 1], 0)
        at = coded.indices.to_numpy().astype(np.int64)
        sizes = (ends - starts)[at]
        ids = self.ids[V.ranges(starts[at], sizes)]
        offsets = np.concatenate([[0], np.cumsum(sizes)])[bounds - bounds[0]]
        return self._with_odd(ids, offsets, texts, odd) if odd.any() else (ids, offsets)

    def _with_odd(self, ids, offsets, texts, odd):
        parts = [ids[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
        rows = np.flatnonzero(odd)
        whole = self.library.encode_batch([texts[int(i)].as_py() for i in rows], add_special_tokens=False)
        for i, e in zip(rows, whole, strict=True):
            parts[i] = np.asarray(e.ids, np.uint32)
        sizes = [len(x) for x in parts]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same documents, each closed by ``end_id``."""
    n = len(offsets) - 1
    new = offsets + np.arange(n + 1)
    out = np.empty(int(new[-1]), np.uint32)
    out[new[1:] - 1] = end_id
    keep = np.ones(len(out), bool)
    keep[new[1:] - 1] = False
    out[keep] = ids
    return out, new
