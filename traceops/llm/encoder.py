"""Token ids of whole texts by the tokenizers library, many texts at a time."""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from traceops.llm.text import coded, spread

#: Chunks that a worker remembers, and the most bytes of one.
CACHE_WORDS, CACHE_BYTES = 300_000, 64
#: Bytes of text that are encoded at once.
ENCODE_BYTES = 3 << 20
# white space other than single blanks and line ends inside a text: such texts are encoded whole
_UNUSUAL = (r"^[ \n]|[ \n]$|[ \n][ \n]|[\x00-\x09\x0b-\x1f\x7f\x{80}-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}"
            r"\x{2028}-\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]|<\|")
_WORDS = 100  # of which the library's tokens are held at once
_SIGNS = "".join(chr(b) for b in range(33, 127) if not chr(b).isalpha())
_LETTERS = r"^\n?[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+$"


def byte_characters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(other)}


def stems_and_tails(chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(stems, tails) of chunks: signs and digits after a word, else only stops after a letter or digit, are a tail.

    The vocabulary's pattern ends a piece between the two, whatever they are.
    """
    word, other = pc.utf8_rtrim(chunks, _SIGNS), pc.utf8_rtrim(chunks, ".,!")
    other = pc.if_else(pc.match_substring_regex(other, r"[\p{L}\p{N}]$"), other, chunks)
    stems = pc.if_else(pc.match_substring_regex(word, _LETTERS), word, other)
    offsets = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset:chunks.offset + len(chunks) + 1]
    start = offsets[:-1] + pc.binary_length(stems).to_numpy()
    size = offsets[1:] - start
    data = np.frombuffer(chunks.buffers()[2], np.uint8)[spread(start, size)]
    return stems, pa.StringArray.from_buffers(len(chunks), pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32)), pa.py_buffer(data))


@functools.lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """One encoder for each worker process; `name` is a vocabulary file, or the name of a public one."""
    return Encoder(name)


class Encoder:
    """Ids as `Tokenizer.encode(text, add_special_tokens=False)` gives them, the id of a special token where its name stands in a text.

    A byte-level vocabulary splits a text before each blank that stands between other characters and around
    each such line end, so the ids of a text are those of its chunks. Chunks are encoded once for a batch;
    a chunk of letters is one word of the model.
    """

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        if not os.path.isabs(name):
            import public_tokenizers

            name = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(name)
        self.model = self.tokenizer.model
        self.chunked = self.tokenizer.normalizer is None and isinstance(self.tokenizer.pre_tokenizer, ByteLevel) \
            and self.tokenizer.pre_tokenizer.use_regex and not self.tokenizer.pre_tokenizer.add_prefix_space
        self.letters = byte_characters()
        # chunks, all their ids, and where those of each chunk start and how many they are
        self.cache = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=np.uint32) for x in found]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts, none of them null."""
        odd = pc.match_substring_regex(texts, _UNUSUAL).to_numpy(zero_copy_only=False) if self.chunked \
            else np.ones(len(texts), dtype=bool)
        if odd.all():
            ids = self.whole(texts.to_pylist())
            return np.append(0, np.cumsum([len(x) for x in ids], dtype=np.int64)), np.concatenate([np.zeros(0, np.uint32), *ids])
        if not odd.any():
            return self._chunks(texts)
        offsets, ids = self._chunks(texts.filter(pa.array(~odd)))
        cut = iter(np.split(ids, offsets[1:-1]))
        apart = iter(self.whole(texts.filter(pa.array(odd)).to_pylist()))
        each = [next(apart) if x else next(cut) for x in odd]
        return np.append(0, np.cumsum([len(x) for x in each], dtype=np.int64)), np.concatenate(each)

    def _chunks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # each line starts a chunk "\nword", any other chunk stands for " word"
        marked = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        offsets, codes, values = coded(pc.split_pattern(marked, " "))
        stems, tails = stems_and_tails(values)
        stems, tails = stems.dictionary_encode(), tails.dictionary_encode()
        flat, start, size = self._ids(stems.dictionary)
        ends = self.whole(tails.dictionary.to_pylist())
        more = np.array([len(x) for x in ends], dtype=np.int32)
        start = np.append(start, len(flat) + np.cumsum(more, dtype=np.int32) - more)
        flat, size = np.concatenate([flat, *ends]), np.append(size, more)
        pair = np.stack([stems.indices.to_numpy(), tails.indices.to_numpy() + len(stems.dictionary)], axis=1)[codes].ravel()
        length = size[pair]
        out = flat[spread(start[pair], length)]
        ends_at = np.append(0, np.cumsum(length, dtype=np.int64))[offsets * 2]
        # the line end put before each text goes again
        keep = np.ones(len(out), dtype=bool)
        keep[ends_at[:-1]] = False
        return ends_at - np.arange(len(ends_at)), out[keep]

    def _ids(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, sizes): where in `ids` those of each distinct chunk lie."""
        known, ids, start, size = self.cache
        place = pc.index_in(stems, known)
        new = stems.filter(pc.is_null(place))
        order, new_ids, new_size = self._new(new)
        at = np.cumsum(new_size, dtype=np.int32) - new_size
        kept = np.flatnonzero(pc.binary_length(new).to_numpy()[order] <= CACHE_BYTES)[:CACHE_WORDS - len(known)]
        if len(kept):
            n = new_size[kept]
            self.cache = (pa.concat_arrays([known, new.take(pa.array(order[kept]))]), np.append(ids, new_ids[spread(at[kept], n)]),
                          np.append(start, len(ids) + np.cumsum(n, dtype=np.int32) - n), np.append(size, n))
        own = np.empty(len(new), np.int32)
        own[order] = np.arange(len(known), len(known) + len(new), dtype=np.int32)
        row = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).copy()
        row[pc.is_null(place).to_numpy(zero_copy_only=False)] = own
        return np.append(ids, new_ids), np.append(start, len(ids) + at)[row], np.append(size, new_size)[row]

    def _new(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order, ids, sizes) of chunks, in another order: the slow ones first, as they gain most from the cache."""
        word, letters = self.model.tokenize, self.letters
        simple = pc.match_substring_regex(stems, _LETTERS)
        line = pc.starts_with(stems, "\n")
        groups = [pc.invert(simple), pc.and_(simple, line), pc.and_not(simple, line)]
        names = stems.filter(groups[0]).to_pylist()
        ids = self.whole([n if n[0] == "\n" else " " + n for n in names]) if names else []
        size = [len(x) for x in ids]
        for group, first, lead in ((groups[1], [t.id for t in word(letters[10])], ""), (groups[2], [], letters[32])):
            names = pc.utf8_ltrim(stems.filter(group), "\n")
            other = np.flatnonzero(pc.invert(pc.string_is_ascii(names)).to_numpy(zero_copy_only=False)).tolist()
            names = names.to_pylist()
            for i in other:
                names[i] = names[i].encode().decode("latin-1").translate(letters)
            for a in range(0, len(names), _WORDS):
                found = [word(lead + n) for n in names[a:a + _WORDS]]
                ids.append(np.array([i for w in found for i in first + [t.id for t in w]], dtype=np.uint32))
                size += [len(first) + len(w) for w in found]
        order = np.concatenate([np.flatnonzero(g.to_numpy(zero_copy_only=False)) for g in groups])
        return order, np.concatenate([np.zeros(0, np.uint32), *ids]), np.array(size, dtype=np.int32)
