"""Token ids by the tokenizers library, one call for each distinct chunk of text.

A text is cut where neither file's pre-tokenizer can join what stands on both sides, so that the ids of the chunks in
order are the ids of the text. The chunks of a slice of texts are coded at once by Arrow, each distinct chunk goes through
the library once while it is remembered, and the ids of all chunks are taken by their codes. A chunk that is one plain word
with signs after it goes straight to the library's model, which takes a quarter of the time of the whole library.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space other than blank and line feed, and the mark that is set at cuts.
OTHER_SPACE = r"\x00\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A text in which any white space is not one blank or one line feed between two visible characters.
UNEVEN = rf"[{OTHER_SPACE}]|[ \n][ \n]|\A[ \n]|[ \n]\z"
_CUT = re.compile(r"(?<=\S)(?= \S)")
LONG = 64  # characters of the longest chunk that is remembered
#: A plain word has letters of Latin-1, which normalisation leaves or puts in lower case, and these signs after it. Both files'
#: pre-tokenizers part the signs from the word, keep a blank with the word if they keep blanks, and cut nothing else.
SIGNS = r"""!"#$%&()*+,-./:;=?@[\]^_`{}~"""
LETTERS = "".join(chr(c) for c in range(256) if chr(c).isalpha())
LATIN = re.compile(f"[{LETTERS}]+")
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Normalizer and pre-tokenizer of which that is known: of files that keep blanks, and of files that do not.
PLAIN = {
    True: (None, _BYTES | {"use_regex": True}),
    False: (
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}, _BYTES | {"use_regex": False}]},
    ),
}
GROUP = 4096  # chunks of one call of the library, whose result takes many times their size


def slices(column: pa.Array, rows: int = 10_000, size: int = 4 << 20) -> Iterator[pa.Array]:
    """Slices of a text column of at most ``rows`` rows and about ``size`` bytes, one text at least; nulls as empty texts."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = sizes[at - 1] if at else 0
        end = min(max(at + 1, int(np.searchsorted(sizes, before + size, side="right"))), at + rows, len(column))
        yield pc.fill_null(column.slice(at, end - at), "")
        at = end


def sliced(batch: pa.RecordBatch, text: int, rows: int = 256, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``rows`` rows and about ``size`` bytes in its column ``text``; nulls stay."""
    at = 0
    for part in slices(batch.column(text), rows, size):
        yield batch.slice(at, len(part))
        at += len(part)


def chunked(texts: pa.Array, spaced: bool) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """Places of texts, their chunks end to end, and the offsets of each text's chunks; every text once, in two parts at most.

    spaced: whether the file's pre-tokenizer keeps a blank with the word after it (byte-level files do). Then even texts
    are cut before blanks and on both sides of line feeds, others only before single blanks between two visible
    characters. Otherwise white space only separates words and every blank and line feed is a cut.
    """
    if not spaced:
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        yield np.arange(len(texts)), parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
        return
    odd = pc.match_substring_regex(texts, UNEVEN)
    even = texts.filter(pc.invert(odd))
    at = odd.to_numpy(zero_copy_only=False)
    if len(even):
        marked = pc.replace_substring(pc.replace_substring(even, " ", "\x00 "), "\n", "\x00\n\x00")
        parts = pc.split_pattern(marked, "\x00")
        yield np.flatnonzero(~at), parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
    if len(even) < len(texts):
        lists = [_CUT.split(t) for t in texts.filter(odd).to_pylist()]
        yield np.flatnonzero(at), pa.array([c for x in lists for c in x], pa.string()), np.cumsum([0, *map(len, lists)])


class Memo:
    """Values of chunks in two generations of about ``size`` bytes together: when the young one is full it becomes the old
    one, and a chunk that is met again moves up. Chunks of more than ``LONG`` characters are never remembered."""

    def __init__(self, size: int):
        self.half, self.held = size // 2, 0
        self.young: dict = {}
        self.old: dict = {}

    def get(self, chunk: str):
        """The value of a chunk if it is remembered; it does not move up."""
        return self.young.get(chunk, self.old.get(chunk))

    def values(self, chunks: list[str], find: Callable[[list[str]], list]) -> list:
        """The value of each of these distinct chunks; ``find`` gives those that are not remembered."""
        if self.held > self.half:
            self.old, self.young, self.held = self.young, {}, 0
        young, old = self.young, self.old
        out = list(map(young.get, chunks))
        missing = [i for i, v in enumerate(out) if v is None]
        new = []
        for i in missing:
            v = old.get(chunks[i])
            if v is None:
                new.append(i)
            else:
                out[i] = young[chunks[i]] = v
        for i, v in zip(new, find([chunks[i] for i in new])):
            out[i] = v
            if len(chunks[i]) <= LONG:
                young[chunks[i]] = v
        self.held += 220 * len(missing)  # about what a short text, its value and its entry take
        return out


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class ChunkEncoder:
    """Ids of whole texts; ``memo_bytes`` bounds what is remembered and changes no result."""

    def __init__(self, path: str, spaced: bool = True, memo_bytes: int = 32 << 20):
        self.tokenizer, self.spaced, self.memo = library(path), spaced, Memo(memo_bytes)
        #: The library cuts a text at special tokens before anything else, so one of them between chunks parts them.
        specials = {i: t for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip or t.single_word)}
        self.mark_id, self.mark = next(((i, t.content) for i, t in sorted(specials.items(), reverse=True)), (None, None))
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.spelled = self._plain()

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string array without nulls; empty texts have none."""
        out: list = [None] * len(texts)
        for places, chunks, offsets in chunked(texts, self.spaced):
            coded = chunks.dictionary_encode()
            known = self.memo.values(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self._ids)
            values = np.frombuffer(b"".join(known), "<u4")
            sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
            firsts = np.cumsum(sizes) - sizes
            codes = coded.indices.to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes[codes])])
            flat = values[np.arange(ends[-1], dtype=np.int32) + np.repeat((firsts[codes] - ends[:-1]).astype(np.int32), sizes[codes])]
            bounds = ends[offsets]
            for i, a, b in zip(places.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                out[i] = flat[a:b]
        return out

    def _plain(self) -> tuple:
        """The library's model, and how characters of plain words are spelled for it; none for a file whose rules are others than ``PLAIN``."""
        rules = json.loads(self.tokenizer.to_str())
        plain = {*SIGNS, *LETTERS, " "}
        if (rules["normalizer"], rules["pre_tokenizer"]) != PLAIN[self.spaced] or rules["model"].get("dropout") or any(set(t) <= plain for t in self.added):
            return None, {}
        from tokenizers.pre_tokenizers import ByteLevel

        level = ByteLevel(add_prefix_space=False, use_regex=False)
        return self.tokenizer.model, {ord(c): "".join(p for p, _ in level.pre_tokenize_str(c)) for c in plain}

    def _words(self, chunks: list[str]) -> list[bytes | None]:
        """The ids of the chunks that are plain words with signs after them, by the library's model; None for others, which take the
        whole library. A word that is remembered, or was met here, without its signs is not asked for again."""
        out: list = [None] * len(chunks)
        if self.model is None:
            return out
        tokenize, spelled, spaced, memo, latin = self.model.tokenize, self.spelled, self.spaced, self.memo, LATIN.fullmatch
        ids_of = lambda x: array("I", [t.id for t in tokenize(x.translate(spelled))]).tobytes()
        met: dict[str, bytes] = {}
        for i, c in enumerate(chunks):
            word = c.rstrip(SIGNS)
            letters = word[1:] if spaced and word[:1] == " " else word
            if not (letters.isalpha() and (letters.isascii() or latin(letters))):
                continue
            if not spaced:
                word = word.lower()
            ids = met.get(word)
            if ids is None:
                ids = met[word] = (memo.get(word) if word != c else None) or ids_of(word)
            at = len(word)
            if at < len(c):
                signs = c[at:]
                if signs not in met:
                    met[signs] = ids_of(signs)
                ids += met[signs]
            out[i] = ids
        return out

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """Plain words go to the model, other chunks without added tokens through the library as one text, parted by a special token; others alone."""
        out: list = self._words(chunks)
        plain = [i for i, c in enumerate(chunks) if out[i] is None and self.mark is not None and len(c) <= LONG and not any(t in c for t in self.added)]
        for first in range(0, len(plain), GROUP):
            group = plain[first : first + GROUP]
            ids = np.array(self.tokenizer.encode_batch_fast([self.mark.join([chunks[i] for i in group])], add_special_tokens=False)[0].ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids)).tolist()
            raw, at = ids.tobytes(), 0
            for i, end in zip(group, ends):
                out[i] = raw[4 * at : 4 * end]
                at = end + 1
        rest = [i for i, x in enumerate(out) if x is None]
        for i in rest:
            out[i] = np.array(self.tokenizer.encode_batch_fast([chunks[i]], add_special_tokens=False)[0].ids, "<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def encoder(path: str, spaced: bool) -> ChunkEncoder:
    """One for each worker process: what it remembers serves all tasks of that worker."""
    return ChunkEncoder(path, spaced)
