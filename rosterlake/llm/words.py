"""Words of the public word vocabulary: its normalisation and splitting, and a bounded word cache."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Fixed value: the vocabulary's pattern for words.
split_words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def text_slices(batch: pa.RecordBatch, most_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most_bytes`` of its column ``text`` each; a longer text is a part of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64)
    group = (np.cumsum(sizes) - sizes) // most_bytes
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def split_batch(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Chunks without ASCII white space of all texts together: each one's place in the list of different
    chunks; how many each text has; and that list. The vocabulary splits at white space
    too, so chunks can be encoded apart; other white space stays inside them. A null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    counts = np.asarray(pc.list_value_length(lists), np.int64)
    coded = flat.dictionary_encode()
    return np.asarray(coded.indices, np.int64), counts, coded.dictionary


def words_of(chunk: str) -> list[bytes]:
    """Lower-case words of a chunk without white space, in UTF-8. Each character is lowered alone."""
    lowered = "".join(c.lower() for c in unicodedata.normalize("NFC", chunk))
    return [w.encode("utf-8", "replace") for w in split_words(lowered)]


class Memo(dict):
    """What ``many`` gives for each of a list of words, in two generations of about ``most`` words: a word
    that no call has asked for while a generation filled up is forgotten, so common ones stay."""

    def __init__(self, many: Callable[[list[str]], list], most: int = 80_000):
        super().__init__()
        self.many, self.most, self.old = many, most, {}

    def learn(self, words: list[str]) -> None:
        """Afterwards every one of ``words`` is a key, until the next call."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        missing = {w for w in words if w not in self}
        if missing:
            known = missing & self.old.keys() if self.old else ()
            for w in known:
                self[w] = self.old[w]
            found = list(missing.difference(known))
            self.update(zip(found, self.many(found)))

    def forget(self) -> None:
        self.clear()
        self.old = {}


def byte_units() -> dict[str, int]:
    """The character that stands for each byte in the files of byte-level vocabularies: printable
    Latin-1 characters for themselves, the others in order from code point 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces_of_vocabulary(path: str, end: str = "</w>") -> list[tuple[int, ...]]:
    """Each token as symbols: its bytes, the last of a word-final token plus 256."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    units = byte_units()
    out = []
    for token in vocabulary:
        final = token.endswith(end) and token != end
        symbols = [units[c] for c in (token.removesuffix(end) if final else token)]
        if final:
            symbols[-1] += 256
        out.append(tuple(symbols))
    return out
