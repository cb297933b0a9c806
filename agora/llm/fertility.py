"""Quality rules from tokeniser fertility.

Two public vocabularies read every word of a text: a byte-fallback piece
vocabulary (characters per token, share of byte-fallback tokens, entropy of
the token distribution) and a multilingual byte-level vocabulary (characters
per token). Each script has its own bands; a text outside one of its bands is
rejected. Words are tokenised by themselves, so a word is encoded once per
Python worker and then looked up; a text never leaves its row.

Base measures (words, symbols, duplicate lines, repeated 3-word windows) come
from the same pass.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame

from agora.llm.common import Memo, id_text, map_batches

SYMBOLS = "#*$%&|<>"
# Words remembered per generation of a Python worker's memo.
MEMO_ENTRIES = 400_000


@dataclass(frozen=True)
class Band:
    """Accepted ranges of one script.

    ``symbol_share`` is the highest accepted share of tokens without any
    letter or digit; ``entropy`` is the least accepted entropy in bits of the
    token distribution of a text of ``entropy_from`` tokens or more.
    """
    piece_chars: tuple[float, float]
    byte_chars: tuple[float, float]
    fallback: float
    symbol_share: float
    entropy: float
    entropy_from: int = 60


# Bands per script. A script that is not listed uses OTHER.
BANDS: dict[str, Band] = {
    "LATIN": Band((1.5, 7.0), (1.5, 7.5), 0.05, 0.18, 3.5),
    "CYRILLIC": Band((1.3, 7.0), (1.0, 7.5), 0.05, 0.18, 3.5),
    "GREEK": Band((0.9, 6.0), (0.8, 6.0), 0.10, 0.18, 3.5),
}
OTHER = Band((0.3, 7.0), (0.3, 7.5), 0.60, 0.30, 3.5)


def script_of(word: str) -> str:
    """Script of a word's first letter: the first word of the letter's Unicode name."""
    for ch in word:
        if ch.isalpha():
            return "LATIN" if ch.isascii() else unicodedata.name(ch, "OTHER").split(" ")[0]
    return "NONE"


def split_words(text: str) -> list[str]:
    """Maximal runs without ASCII white space (bytes.split splits at just those six)."""
    joined = b"\n".join(text.encode("utf-8").split()).decode("utf-8")
    return joined.split("\n") if joined else []


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more in ``words``."""
    if len(set(zip(words, words[1:], words[2:]))) == max(0, len(words) - 2):
        return 0
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64,
                      count=len(words))
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(seen) + ids[2:]
    _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[where] > 1)
    inside = np.zeros(len(words), dtype=bool)
    for k in range(3):
        inside[at + k] = True
    return int(inside.sum())


def duplicate_lines(text: str) -> int:
    """Lines (split at line feeds) with a word that equal an earlier line."""
    lines = [ln for ln in text.split("\n") if ln.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


class Measure:
    """Measures of one text under the two vocabularies."""

    def __init__(self, piece_model: bytes, ranks: Mapping[bytes, int], pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        n = self.pieces.vocab_size()
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(n)])
        self.symbol = np.array([not any(c.isalnum() for c in self.pieces.id_to_piece(i))
                                for i in range(n)]) & ~self.fallback
        self.starts = np.array([self.pieces.id_to_piece(i).startswith("\u2581") for i in range(n)])
        self.spaced = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.spaced[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.bytes_of = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=dict(ranks),
                                          special_tokens={})
        self.limit = n
        self.scripts: list[str] = []
        self.memo = Memo(lambda word: self.learn([word])[0], MEMO_ENTRIES)

    def piece_ids(self, words: list[str]) -> list[list[int]]:
        """Piece ids of each word, from one call: a word's first piece alone starts with the mark."""
        ids = np.array(self.pieces.encode(" ".join(words)), dtype=np.intc)
        at = np.flatnonzero(self.starts[ids]) if len(ids) else ids
        if len(at) != len(words) or len(at) and at[0]:      # a word that normalises to none or two
            return self.pieces.encode(words, num_threads=1)
        ids, ends = ids.tolist(), [*at[1:].tolist(), len(ids)]
        return [ids[i:j] for i, j in zip(at.tolist(), ends)]

    def byte_counts(self, words: list[str]) -> list[int]:
        """Byte-level tokens of each word after a space; only a word's first token has the space."""
        ids = self.bytes_of.encode_ordinary("".join(" " + w for w in words))
        at = np.flatnonzero(self.spaced[ids]) if ids else np.zeros(0, int)
        if len(at) != len(words) or len(at) and at[0]:
            return [len(self.bytes_of.encode_ordinary(" " + w)) for w in words]
        return np.diff(np.append(at, len(ids))).tolist()

    def learn(self, words: list[str]) -> list[bytes]:
        """A word's piece ids, then limit + its byte-level tokens, then -1 - its script's number."""
        out = []
        if not words:
            return out
        for word, ids, n in zip(words, self.piece_ids(words), self.byte_counts(words)):
            script = script_of(word)
            if script not in self.scripts:
                self.scripts.append(script)
            ids.append(self.limit + n)
            ids.append(-1 - self.scripts.index(script))
            out.append(array("i", ids).tobytes())
        return out

    def __call__(self, text: str) -> dict:
        words = split_words(text)
        memo = self.memo
        memo.rest()
        new = [w for w in set(words) if w not in memo and w not in memo.old]
        memo.update(zip(new, self.learn(new)))
        codes = np.frombuffer(b"".join(map(memo.__getitem__, words)), dtype=np.intc)
        tokens = codes[(codes >= 0) & (codes < self.limit)]
        n, n_bytes = len(tokens), int((codes[codes >= self.limit] - self.limit).sum())
        chars = sum(map(len, words))
        counts = np.bincount(tokens)
        share = counts[counts > 0] / max(n, 1)
        return {"n_words": len(words), "word_chars": chars,
                "n_symbols": sum(map(text.count, SYMBOLS)),
                "n_dup_lines": duplicate_lines(text), "n_repeat_words": repeated_words(words),
                "script": self.main_script(codes[codes < 0]), "n_tokens": n,
                "piece_chars": chars / n if n else None,
                "byte_chars": chars / n_bytes if n_bytes else None,
                "fallback_share": float(self.fallback[tokens].sum()) / n if n else None,
                "symbol_share": float(self.symbol[tokens].sum()) / n if n else None,
                "entropy": max(0.0, float(-(share * np.log2(share)).sum())) if n else None}

    def main_script(self, codes: np.ndarray) -> str:
        """Script of most words that have a letter (ties: the first by name)."""
        words = {self.scripts[i]: -c for i, c in enumerate(np.bincount(-1 - codes)) if c}
        words.pop("NONE", None)
        return min(words, key=lambda s: (words[s], s)) if words else "NONE"


def inside(m: dict, bands: Mapping[str, Band] = BANDS) -> bool:
    """Whether a text's measures lie in its script's bands; a text without tokens does not."""
    if not m["n_tokens"]:
        return False
    band = bands.get(m["script"], OTHER)
    return (band.piece_chars[0] <= m["piece_chars"] <= band.piece_chars[1]
            and band.byte_chars[0] <= m["byte_chars"] <= band.byte_chars[1]
            and m["fallback_share"] <= band.fallback
            and m["symbol_share"] <= band.symbol_share
            and (m["n_tokens"] < band.entropy_from or m["entropy"] >= band.entropy))


FIELDS = [("n_words", pa.int64(), "long"), ("word_chars", pa.int64(), "long"),
          ("n_symbols", pa.int64(), "long"), ("n_dup_lines", pa.int64(), "long"),
          ("n_repeat_words", pa.int64(), "long"), ("base_failed", pa.bool_(), "boolean"),
          ("kept", pa.bool_(), "boolean"), ("script", pa.string(), "string"),
          ("n_tokens", pa.int64(), "long"), ("piece_chars", pa.float64(), "double"),
          ("byte_chars", pa.float64(), "double"), ("fallback_share", pa.float64(), "double"),
          ("symbol_share", pa.float64(), "double"), ("entropy", pa.float64(), "double")]


def rules(docs: DataFrame, piece_model: bytes, ranks: Mapping[bytes, int], pattern: str,
          bands: Mapping[str, Band] = BANDS, min_words: int = 50, max_repeat: int = 50,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the columns of ``FIELDS`` for every whole text.

    ``base_failed``: fewer than ``min_words`` words, or more than
    ``max_repeat`` percent of the words in repeated windows. ``kept``: not
    base_failed and inside the bands of the text's script. NULL text is empty
    text: no words, base_failed, measures NULL. Repeated rows and NULL ids are
    kept as they are.
    """
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast((piece_model, dict(ranks)))

    def make():
        measure = Measure(*model.value, pattern)

        def run(cols):
            found = [measure(t) for t in cols["text"]]
            for m in found:
                m["base_failed"] = (m["n_words"] < min_words
                                    or 100 * m["n_repeat_words"] > max_repeat * m["n_words"])
                m["kept"] = not m["base_failed"] and inside(m, bands)
            return {"doc_id": cols["doc_id"]} | {n: [m[n] for m in found] for n, _, _ in FIELDS}
        return run
    return map_batches(id_text(docs, id_col, text_col), make,
                       pa.schema([("doc_id", pa.int64()), *[(n, t) for n, t, _ in FIELDS]]),
                       ", ".join(["doc_id long", *[f"{n} {t}" for n, _, t in FIELDS]]))
