"""Encoding of whole texts with the tokenizers library, memoised by word.

For a byte-level BPE whose pre-tokenizer splits white space from words, a
single space or newline between two non-white-space characters always ends a
pre-token, so the ids of a text are the ids of its space-delimited pieces in
order.  Pieces repeat, so each worker keeps a bounded memo of piece ids.  Texts
with other white-space layouts (runs, tabs beside a space, edges) are encoded
whole, and so is everything under any other kind of tokenizer.
"""

from __future__ import annotations

import gc
import json
import os
import struct

import numpy as np
import pyarrow as pa

MEMO_PIECES = 1_500_000
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_OPEN: dict[str, "Encoder"] = {}


class _Memo(dict):
    """Piece -> id bytes; a piece that no memo holds asks for a batch."""

    def __init__(self, encoder: "Encoder", prefix: str):
        super().__init__()
        self.encoder, self.prefix = encoder, prefix

    def learn(self, pieces: set[str]) -> None:
        """Encode new pieces.  A run of punctuation after a letter is a pre-token of
        its own, so a word with any such tail is encoded once, without it."""
        plain, tailed, tails, added = set(), [], self.encoder.tails, self.encoder.added
        for p in pieces:
            if not p or p.strip() != p:
                continue
            stem = p.rstrip(PUNCTUATION)
            if len(stem) < len(p) and stem and stem[-1].isalpha() and not any(t in p for t in added):
                tailed.append((p, stem))
                if stem not in self:
                    plain.add(stem)
                tail = p[len(stem):]
                if tail not in tails:
                    tails[tail] = self.encoder.encode_whole([tail])[0]
            else:
                plain.add(p)
        words = [p for p in plain if p.isalpha()]
        self.update(zip(words, self.encoder.encode_words([self.prefix + p for p in words]), strict=True))
        other = [p for p in plain if not p.isalpha()]
        self.update(zip(other, self.encoder.encode_pieces([self.prefix + p for p in other]), strict=True))
        self.update([(p, self[stem] + tails[p[len(stem):]]) for p, stem in tailed])


def byte_characters() -> dict[int, str]:
    """How byte-level tokenizers write each byte: printable Latin-1 as itself, the
    others, in order, as the characters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                         and not spec.get("normalizer") and not spec.get("post_processor"))
        # an added token's text could hold a space or join pieces
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.by_piece = self.by_piece and not any(c.isspace() for t in self.added for c in t)
        self.model = self.tok.model
        self.letters = byte_characters()
        self.tails: dict[str, bytes] = {}
        self.newline = self.encode_whole(["\n"])[0]
        self.first, self.rest = _Memo(self, ""), _Memo(self, " ")

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of letters after at most one space: each is one pre-token, so the
        library's model can be asked for it directly."""
        ask, table, pack = self.model.tokenize, self.letters, struct.pack
        width = "H" if self.dtype.itemsize == 2 else "I"
        shape = [f"<{n}{width}" for n in range(33)]
        out = []
        for w in words:
            ids = [t.id for t in ask(w.encode().decode("latin-1").translate(table))]
            out.append(pack(shape[len(ids)] if len(ids) < 33 else f"<{len(ids)}{width}", *ids))
        return out

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """As ``encode_whole``, in one call that keeps the pieces apart."""
        if not pieces:
            return []
        got = self.tok.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(got.ids, self.dtype).tobytes()
        at = np.searchsorted(np.array(got.word_ids, np.int64), np.arange(len(pieces) + 1)) * self.dtype.itemsize
        at = at.tolist()
        return [ids[a:b] for a, b in zip(at, at[1:], strict=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Id bytes (little-endian, the vocabulary's width) of each whole text."""
        texts = [t or "" for t in texts]
        if not texts:
            return []
        for memo in (self.first, self.rest, self.tails):
            if len(memo) > MEMO_PIECES:
                memo.clear()
        if not self.by_piece:
            return self.encode_whole(texts)
        gc.disable()  # millions of short-lived lists and no cycles
        try:
            return self._by_piece(texts)
        finally:
            gc.enable()

    def _by_piece(self, texts: list[str]) -> list[bytes]:
        """A piece is taken with the space or newline before it (a newline before each
        text), so equal ones are looked up once and the ids gathered in one buffer."""
        raw = [t.encode() for t in texts]
        starts = np.cumsum([0, *[len(t) + 1 for t in raw]])
        data = b"".join([x for t in raw for x in (b"\n", t)])
        byte = np.frombuffer(data, np.uint8)
        at = np.flatnonzero((byte == 32) | (byte == 10))
        pieces = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        which, words = coded.indices.to_numpy(), coded.dictionary
        _, offsets, flat = words.buffers()
        ends = np.frombuffer(offsets, np.int64)[: len(words) + 1]
        leads = np.flatnonzero(np.frombuffer(flat, np.uint8)[ends[:-1]] == 10).tolist()
        names = str(flat[: ends[-1]], "utf-8").replace("\n", " ").split(" ")[1:]
        asked = {names[i] for i in leads}
        self.first.learn({p for p in asked if p not in self.first})
        ids = list(map(self.rest.get, names))
        for i in leads:
            ids[i] = b""
        gaps = [i for i, v in enumerate(ids) if v is None]
        self.rest.learn({names[i] for i in gaps})
        for i in gaps:
            ids[i] = self.rest.get(names[i])
        for i in leads:
            known = self.first.get(names[i])
            ids[i] = None if known is None else self.newline + known
        _, offsets, flat = pa.array(ids, pa.large_binary()).take(coded.indices).buffers()
        text = np.searchsorted(at, starts)
        cuts = np.frombuffer(offsets, np.int64)[text].tolist()
        view, skip = memoryview(flat or b""), len(self.newline)
        out = [bytes(view[a + skip:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        unknown = np.array([v is None for v in ids], bool)
        whole = np.unique(np.searchsorted(text, np.flatnonzero(unknown[which]), side="right") - 1).tolist()
        for i, got in zip(whole, self.encode_whole([texts[i] for i in whole]), strict=True):
            out[i] = got
        return out


def encoder(path: str) -> Encoder:
    """This worker's encoder for the vocabulary file, opened once."""
    if path not in _OPEN:
        _OPEN[path] = Encoder(path)
    return _OPEN[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
