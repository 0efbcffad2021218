"""Token ids by a public tokenizer, each different word encoded once per worker."""

from __future__ import annotations

import gc
import os
import string

import numpy as np
import pyarrow as pa

from matchforge.llm.common import byte_values, slices, text_bytes, unit_hashes

# Words remembered per Python worker; a full memory is emptied and filled anew.
MEMORY_WORDS = 500_000
# Bytes of text encoded at a time.
ENCODE_BYTES = 1 << 20
_GAPS = b" \n\t"
_PUNCTUATION = string.punctuation.replace("'", "")
_ENCODERS: dict[str, "WordEncoder"] = {}


def byte_letters() -> dict[int, str]:
    """The letter that byte-level models write for each byte: printable bytes as they are."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


class WordEncoder:
    """Encodes whole texts through a memory of the words met so far.

    The tokenizer lower-cases, drops white space and splits runs of letters from
    runs of punctuation before it encodes, so the ids of a text are those of its
    units in order: texts are cut at the three commonest separators and between an
    ASCII letter and an ASCII punctuation mark (not the apostrophe, which starts
    contractions). Units are told apart by a 64-bit hash of their bytes, with A-Z
    as a-z. A unit met for the first time goes to the tokenizer's model if it is
    plain letters below U+0180, else through the whole tokenizer. Texts in which a
    special token may be spelled out are encoded whole.
    """

    def __init__(self, path: str, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.plain_specials = plain_specials
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.values = byte_values(True, _GAPS)
        self.kinds = np.zeros(256, np.uint8)
        self.kinds[[*range(65, 91), *range(97, 123)]] = 1
        self.kinds[list(_PUNCTUATION.encode())] = 2
        self._forget()

    def _forget(self) -> None:
        self.number: dict[int, int] = {}
        self.flat = np.zeros(1 << 18, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, hashes: list[int], raw: np.ndarray, starts: np.ndarray, which: np.ndarray) -> None:
        ends = np.append(starts[1:], len(raw))[which].tolist()
        data = raw.tobytes().lower()
        tokenize, ids, sizes = self.model.tokenize, [], []
        for a, b in zip(starts[which].tolist(), ends):
            unit = data[a:b].rstrip(_GAPS).decode()
            if not unit.isalpha():
                got = self._whole(unit)
            elif unit.isascii():
                got = [t.id for t in tokenize(unit)]
            elif max(unit) < "ƀ" and "İ" not in unit:
                got = [t.id for t in tokenize(unit.lower().encode().decode("latin-1").translate(self.letters))]
            else:
                got = self._whole(unit)
            ids += got
            sizes.append(len(got))
        known, end = len(self.number), self.used + len(ids)
        while end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while known + len(sizes) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.flat[self.used:end] = ids
        self.length[known:known + len(sizes)] = sizes
        self.start[known:known + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.number.update(zip(hashes, range(known, known + len(sizes))))
        self.used = end

    def _slice(self, raw: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts with their end ids, and the number of ids of each."""
        if len(self.number) > MEMORY_WORDS:
            self._forget()
        hashes, starts = unit_hashes(raw, at, self.values, self.kinds)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        if new := [i for i, h in enumerate(keys) if h not in self.number]:
            self._learn([keys[i] for i in new], raw, starts, first[new])
        numbers = np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))[back]
        sizes, begin = self.length[numbers], self.start[numbers]
        upto = np.cumsum(sizes)
        total = int(upto[-1]) if len(upto) else 0
        units = np.searchsorted(starts, at)
        ends = np.concatenate([[0], upto])[units]
        texts = len(at) - 1
        # every text moves the ids behind it by one place, for its end id
        shift = np.repeat(np.arange(texts), np.diff(ends))
        spot = np.arange(total)
        out = np.full(total + texts, end_id, np.uint32)
        out[spot + shift] = self.flat[spot + np.repeat(begin - (upto - sizes), sizes)]
        return out, np.diff(ends) + 1

    def encode(self, texts: pa.Array, end_id: int):
        """Yield ids of runs of texts, each text closed by ``end_id``, with the ids per text."""
        raw, at = text_bytes(texts)
        collecting = gc.isenabled()
        gc.disable()  # the memory is many small objects that never form cycles
        try:
            for a, b in slices(at, ENCODE_BYTES):
                part = raw[at[a]:at[b]]
                if b"<|" not in part.tobytes() or self.plain_specials:
                    yield self._slice(part, at[a:b + 1] - at[a], end_id)
                    continue
                for i in range(a, b):
                    one = raw[at[i]:at[i + 1]]
                    if b"<|" in (text := one.tobytes()):
                        ids = np.array([*self._whole(text.decode()), end_id], np.uint32)
                        yield ids, np.array([len(ids)])
                    else:
                        yield self._slice(one, np.array([0, len(one)]), end_id)
        finally:
            if collecting:
                gc.enable()


def encoder(path: str, plain_specials: bool = False) -> WordEncoder:
    """One encoder per Python worker and file, kept between tasks."""
    key = f"{path}|{plain_specials}"
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, plain_specials)
    return _ENCODERS[key]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
