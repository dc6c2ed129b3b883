"""Encoding texts with a public tokenizer file, per task, through a bounded cache of white-space chunks."""
from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: Chunks in each of a worker's two generations (about 200 bytes each); beyond it the older one is forgotten.
CACHE_CHUNKS = 500_000
#: Texts whose chunks are looked up together.
TEXTS_AT_ONCE = 256
#: Latin letters (all below U+0250 but the dotted capital I, whose lower case is two characters), then a run of marks that is
#: one pre-token of its own.
SIMPLE = re.compile("([A-Za-zªµºÀ-ÖØ-öø-\u012f\u0131-\u024f]+)([.,;:!?*$%&#|()]*)").fullmatch


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def encoder(path: str, ordinary_specials: bool = False) -> "ChunkEncoder":
    """The worker's encoder: a reused worker keeps the loaded tokenizer and its cache for its next tasks."""
    return ChunkEncoder(path, ordinary_specials)


class ChunkEncoder:
    """Encodes texts chunk by chunk, a chunk being what stands between spaces or line feeds.

    The tokenizer drops white space, and neither its normalizer nor its pre-tokens reach across a space or line feed,
    so a text's ids are its chunks' ids joined.  Known chunks are looked up.  A new chunk of Latin letters with
    marks after them is its lower-case word and its marks; new words are encoded together, one space between them,
    and cut after the ids that end a word.  Every other new chunk is encoded on its own.
    ``tests/llm/test_operators.py`` compares the ids with those of whole texts.
    """

    def __init__(self, path: str, ordinary_specials: bool = False):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = ordinary_specials
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(size, bool)
        for token, i in self.tok.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, chunks: Iterable[str]) -> dict[str, bytes]:
        """The ids of chunks that aren't known, as bytes."""
        known, split, words, single = self.known, [], set(), []
        for c in chunks:
            hit = SIMPLE(c)
            if hit:
                body, tail = hit[1].lower(), hit[2]
                split.append((c, body, tail))
                words.add(body)
                if tail:
                    words.add(tail)
            else:
                single.append(c)
        words = [w for w in words if w not in known]
        new: dict[str, bytes] = {}
        if words:
            (all_words,) = self.tok.encode_batch_fast([" ".join(words)], add_special_tokens=False)
            ids = np.array(all_words.ids, self.dtype)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(words) and cut[-1] == len(ids):
                raw = ids.tobytes()
                ends = (cut * self.dtype.itemsize).tolist()
                new = {w: raw[a:b] for w, a, b in zip(words, [0, *ends], ends)}
            else:
                single += set(words).difference(c for c, _, _ in split)
        for c, e in zip(single, self.tok.encode_batch_fast(single, add_special_tokens=False) if single else ()):
            new[c] = np.array(e.ids, self.dtype).tobytes()
        for c, body, tail in split:
            ids = new.get(body) or known.get(body)
            marks = (new.get(tail) or known.get(tail)) if tail else b""
            new[c] = ids + marks if ids and marks is not None else np.array(self.tok.encode(c, add_special_tokens=False).ids, self.dtype).tobytes()
        return new

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """All ids of each text (null or empty: none), in order."""
        texts = list(texts)
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            chunked = [t.replace("\n", " ").split(" ") if t else () for t in texts[at:at + TEXTS_AT_ONCE]]
            if len(self.known) > CACHE_CHUNKS:
                self.known, self.older = {}, self.known
            new = set().union(*chunked).difference(self.known)
            if new:
                old = {c: self.older[c] for c in new if c in self.older}
                self.known.update(old)
                self.known.update(self._learn(new.difference(old)))
            get = self.known.__getitem__
            for chunks in chunked:
                yield np.frombuffer(b"".join(map(get, chunks)), self.dtype)
