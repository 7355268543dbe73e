"""Token ids and counts as a public tokenizer's own library gives them.

``Encoder`` runs in tasks.  For a byte-level BPE file without a normaliser,
texts are cut where white space follows a character that is none: no token
crosses such a place and nothing after it depends on what stands before, so
the ids of a text are those of its pieces in order.  Each distinct piece is
encoded by the library once and kept.  Any other file is given whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import types

import numpy as np

from .words import Powers, slices, span_hashes

KEEP = 2_000_000  # distinct pieces that an encoder keeps at most (about 100 MB)


def version(path: str) -> str:
    """Digest of a tokenizer: library, its version, and the file's bytes."""
    import sentencepiece
    import tokenizers

    lib = tokenizers if path.endswith(".json") else sentencepiece
    with open(path, "rb") as f:
        return hashlib.sha256(f"{lib.__name__} {lib.__version__} ".encode() + f.read()).hexdigest()


def _piece_ends() -> np.ndarray:
    """By byte: 1 ends a non-space character (ASCII), 2 is a trail byte."""
    t = np.zeros(256, np.uint8)
    t[0x21:0x7F] = 1
    t[0x80:0xC0] = 2
    return t


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.powers, self.ends = Powers(), _piece_ends()
        self.pieces = False
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tk = Tokenizer.from_file(path)
            tk.no_truncation()
            tk.no_padding()
            with open(path) as f:
                spec = json.load(f)
            pre = spec.get("pre_tokenizer") or {}
            self.pieces = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                           and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                           and not any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] or "\n" in t["content"]
                                       for t in spec.get("added_tokens", [])))
            self.encode = lambda xs: [e.ids for e in tk.encode_batch_fast(xs, add_special_tokens=False)]
            if self.pieces:  # byte-level tokens have a character for each byte
                self.width = np.array([len(tk.id_to_token(i) or "") for i in range(tk.get_vocab_size())])
        else:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda xs: sp.encode(xs, num_threads=1)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # ascending hashes of the known pieces
        self.slots = np.zeros(0, np.int64)
        self.known = 0
        self.length = np.zeros(1024, np.int64)
        self.start = np.zeros(1024, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _encode_pieces(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the byte spans and how many each has.

        Spans that start with white space and end in none are given to the
        library joined; token widths tell where each ends.
        """
        raw = buf.tobytes()
        free = ((buf[s] == 0x20) | (buf[s] == 0x0A)) & self.ended[e - 1]
        order = np.concatenate([np.flatnonzero(free), np.flatnonzero(~free)])
        spans = [raw[a:b] for a, b in zip(s[order].tolist(), e[order].tolist())]
        k = int(free.sum())
        texts = [b"".join(spans[i: min(k, i + 256)]).decode() for i in range(0, k, 256)]
        ids = self.encode(texts + [x.decode() for x in spans[k:]])
        flat = np.concatenate([np.array(x, np.uint32) for x in ids] or [np.zeros(0, np.uint32)])
        ends = np.cumsum(self.width[flat])
        upto = np.searchsorted(ends, np.cumsum((e - s)[order]), "right")
        size = np.diff(upto, prepend=0)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return flat, np.stack([upto - size, size])[:, back]

    def _learn(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> None:
        n, k = self.known, len(s)
        if n + k > len(self.length):
            self.length, self.start = (np.concatenate([a, np.zeros(max(k, len(a)), np.int64)])
                                       for a in (self.length, self.start))
        flat, (start, size) = self._encode_pieces(buf, s, e)
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(flat), len(self.pool)), np.uint32)])
        self.pool[self.used: self.used + len(flat)] = flat
        self.length[n: n + k] = size
        self.start[n: n + k] = self.used + start
        self.used += len(flat)
        self.known += k

    def _slots(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each piece, and each text's first piece (n + 1 values)."""
        n = len(buf)
        if not n:
            return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
        kind = self.ends[buf]
        ended = kind == 1
        # a two-byte character from U+00C0 on is no white space
        ended[1:] |= (kind[1:] == 2) & (buf[:-1] >= 0xC3) & (buf[:-1] < 0xE0)
        self.ended = ended
        cut = np.zeros(n + 1, bool)
        cut[1:n] = ended[:-1] & ((buf[1:] == 0x20) | (buf[1:] == 0x0A))
        cut[off] = True
        cut[n] = False
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        seen, at, back = np.unique(span_hashes(buf, starts, ends, self.powers), return_index=True, return_inverse=True)
        if self.known + len(seen) > KEEP:
            self._clear()
        pos = np.searchsorted(self.keys, seen)
        new = np.ones(len(seen), bool)
        inside = pos < len(self.keys)
        new[inside] = self.keys[pos[inside]] != seen[inside]
        if new.any():
            was = self.known
            self._learn(buf, starts[at[new]], ends[at[new]])
            self.slots = np.insert(self.slots, pos[new], np.arange(was, self.known))
            self.keys = np.insert(self.keys, pos[new], seen[new])
            pos = np.searchsorted(self.keys, seen)
        return self.slots[pos][back], np.searchsorted(starts, off)

    def counts(self, column) -> np.ndarray:
        """Token counts of the texts of an Arrow column."""
        out = np.zeros(len(column), np.int64)
        for row, buf, off in slices(column):
            if self.pieces:
                slots, first = self._slots(buf, off)
                total = np.concatenate([[0], np.cumsum(self.length[slots])])
                out[row: row + len(off) - 1] = total[first[1:]] - total[first[:-1]]
            else:
                texts = _texts(buf, off)
                out[row: row + len(texts)] = [len(x) for x in self.encode(texts)]
        return out

    def ids(self, column):
        """(first row, flat ids, offsets) for runs of rows of an Arrow column."""
        for row, buf, off in slices(column):
            if self.pieces:
                slots, first = self._slots(buf, off)
                size = self.length[slots]
                total = np.concatenate([[0], np.cumsum(size)])
                at = np.repeat(self.start[slots] - total[:-1], size) + np.arange(total[-1])
                yield row, self.pool[at], total[first]
            else:
                ids = self.encode(_texts(buf, off))
                size = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                yield row, np.fromiter((i for x in ids for i in x), np.uint32, int(size[-1])), size


def _texts(buf: np.ndarray, off: np.ndarray) -> list[str]:
    raw, o = buf.tobytes(), off.tolist()
    return [raw[a:b].decode() for a, b in zip(o[:-1], o[1:])]


def encoder(path: str) -> Encoder:
    """This worker process's encoder of a file (tasks that share a worker share it)."""
    kept = sys.modules.setdefault("_encoders", types.ModuleType("_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]
