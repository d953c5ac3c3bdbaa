"""Token ids of whole texts with a ``tokenizers`` file, a batch of texts at once.

Texts are split into the matches of the file's published pre-tokenizer pattern with array operations,
and each distinct match is encoded once while its worker remembers it (tables of fixed size):

* byte-level files go through the codec of operator 11, where the file's merges rank tokens in the
  order of their ids;
* the lower-case word file looks its words up in a table; new ones are given to the library in one
  text of them all, whose ids part behind each token that ends a word.

Texts with the string of an added token (``<|endoftext|>``), and for the word file those with
characters outside printable Latin (which its normalizer may change), are given to the library whole.
So the ids are those of the file with ``add_special_tokens=False``.
"""

from __future__ import annotations

import json
import os
import re
from functools import partial

import numpy as np

from cinemetric.llm import byte_bpe
from cinemetric.llm.idtable import SHORT, IdTable, word_view
from cinemetric.llm.recent import Recent

#: Printable Latin characters: no combining marks, no white space but the two plain ones.
_LATIN = re.compile("[ \n!-~" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0xA1, 0x12F), (0x131, 0x24F))) + "]*")
#: Fixed value: the pre-tokenizer pattern of the word file.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
WORD_END = "</w>"
_ENCODERS: dict[str, "Encoder"] = {}


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies name visible bytes by themselves, the others from 256 on in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def _ranked_tokens(model: dict) -> list[bytes] | None:
    """Token bytes by id, if the merges rank tokens in the order of their ids."""
    byte_of = {c: b for b, c in _byte_letters().items()}
    by_id = sorted(model["vocab"].items(), key=lambda kv: kv[1])
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    results = [model["vocab"].get(a + b) for a, b in pairs]
    if model.get("end_of_word_suffix") or results != list(range(256, 256 + len(results))) or [i for _, i in by_id] != list(range(len(by_id))):
        return None
    return [bytes(byte_of[c] for c in name) for name, _ in by_id]


class WordEncoder:
    """Ids of printable Latin texts by the lower-case word file."""

    def __init__(self, tokenizer, model: dict, classes: np.ndarray):
        self.tokenizer, self.classes = tokenizer, classes
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        self.ends[[i for name, i in model["vocab"].items() if name.endswith(WORD_END)]] = True
        self.table, self.recent = IdTable(), Recent(byte_bpe.CACHE_BYTES)

    def _library(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.tokenizer.encode(b" ".join(words).decode(), add_special_tokens=False).ids, np.uint32)
        return ids, np.diff(np.flatnonzero(self.ends[ids]) + 1, prepend=0)

    def _long(self, words: list[bytes]) -> list[bytes]:
        ids, counts = self._library(words)
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])]

    def _short(self, raw: bytes, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._library([raw[a:b] for a, b in zip(at.tolist(), (at + size).tolist())])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\0".join(texts).lower() + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = self.classes[codes]
        edges = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        classes[edges] = byte_bpe.EDGE
        begins = classes == byte_bpe.NUMBER
        begins[1:] |= classes[1:] != classes[:-1]
        begins[0] = True
        byte_bpe.split_contractions(codes, begins)
        raw, at = joined.encode(), np.flatnonzero(begins)
        kinds = classes[at]
        at, size = byte_bpe.byte_spans(raw, codes, at)
        text = np.cumsum(kinds == byte_bpe.EDGE)
        kept = kinds < byte_bpe.SPACE
        at, size, text = at[kept], size[kept], text[kept]
        ids, counts = byte_bpe.looked_up(raw, word_view(raw), at, size, self.table, partial(self._short, raw), self.recent, self._long)
        sizes = np.bincount(text, counts, len(texts)).astype(np.int64)
        return np.split(ids, np.cumsum(sizes)[:-1])


class Encoder:
    """``encode(texts)`` gives one uint16 little-endian ids buffer per text (null: no ids)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        added = self.tokenizer.get_added_tokens_decoder().values()
        strings = [a.content for a in added]
        self.added = re.compile("|".join(map(re.escape, strings)) or "(?!)", re.I if any(a.normalized for a in added) else 0)
        # what all their strings begin with, as far as case does not matter: quick to look for
        self.lead = re.match(r"[!-@\[-`{-~]*", os.path.commonprefix(strings))[0]
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        tokens = _ranked_tokens(file["model"]) if file["normalizer"] is None else None
        self.codec = self.words = None
        if tokens:
            self.codec = byte_bpe.Codec(tokens, byte_bpe.PerfectHash.build(tokens), byte_bpe.character_classes())
        elif file["model"].get("end_of_word_suffix") == WORD_END and WORD_PATTERN in json.dumps(file["pre_tokenizer"]).replace("\\\\", "\\"):
            self.words = WordEncoder(self.tokenizer, file["model"], byte_bpe.character_classes())

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _plain(self, text: str) -> bool:
        if self.lead in text and self.added.search(text):
            return False
        return self.codec is not None or (self.words is not None and bool(_LATIN.fullmatch(text)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out = [b""] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if t and self._plain(t):
                plain.append(i)
            elif t:
                out[i] = self._library(t)
        if self.codec is not None:
            for i, ids in zip(plain, self.codec.encode([texts[i] for i in plain])):
                out[i] = ids.astype("<u2").tobytes()
            return out
        held, chars = [], 0
        for k, i in enumerate(plain):
            held.append(i)
            chars += len(texts[i])
            if chars >= byte_bpe.BATCH_CHARS or k + 1 == len(plain):
                for j, ids in zip(held, self.words.encode([texts[j] for j in held])):
                    out[j] = ids.astype("<u2").tobytes()
                held, chars = [], 0
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file; a worker keeps one, the last it used."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)
