"""Token ids of whole texts from a public tokenizer file, exact and with each word encoded once.

Byte-pair tokenizers of this kind cut a text into pre-tokens and encode each by itself. No pre-token
reaches over white space, but for one leading space. So texts are cut there, some megabytes at a
time; every distinct piece among them is encoded by the tokenizers library or found in a cache of
words, and the ids are put together again by their numbers.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfwise.llm.common import kept

# A cache of words has two halves of this size; the older one goes when the newer one is full. Where
# words after a space have ids of their own, these get a half of it, and words without one a quarter.
CACHE_WORDS = 400_000
# Texts that are cut into pieces together.
GROUP_CHARS = 4 << 20

# White space in Python, but not in the tokenizers' patterns.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_RARE_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PAIRS = ("  ", "\n\n", " \n", "\n ")
# White space other than one space or line feed between two words.
_ODD = re.compile(r"\s\s+|[^\S \n]|\A\s|\s\Z")
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Letters whose lower case and normal form are plain.
_PLAIN_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# How a word stands in a text: after a space, after nothing that belongs to it, after a line feed.
_SPACED, _BARE, _NEW_LINE = range(3)


def encoder(path: str) -> Encoder:
    """The encoder that this worker process keeps: words of earlier tasks are known to later ones."""
    return kept("encoder", path, lambda: Encoder(path))


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Encodes texts with a tokenizer file; ids come as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._spaced = self._plain(" a") != self._plain("a")
        self._most = (CACHE_WORDS // 4, CACHE_WORDS // 2) if self._spaced else (CACHE_WORDS, 0)
        # Ids of plain words after a space and of such without, the newer and the older half; ids of
        # other pieces.
        self._words: list[dict[str, bytes]] = [{}, {}]
        self._older: list[dict[str, bytes]] = [{}, {}]
        self._other: dict[str, bytes] = {}
        # A plain word is one pre-token, so the model alone can encode it once it is normalised and
        # its bytes are written as the model's letters. What that does is asked of the library.
        self._tokenize = self._tokenizer.model.tokenize
        letters = " " + "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]))
        normal = self._tokenizer.normalizer or normalizers.Sequence([])
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._letters = {
            ord(c): shown.pre_tokenize_str(n)[0][0]
            for c in letters
            if _PLAIN_WORD.fullmatch(c) or c == " "
            for n in [normal.normalize_str(c)]
        }

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        # A text's parts are ids, and numbers of stretches whose ids are found together.
        parts: list[list] = []
        stretches: list[str] = []
        spaced: list[bool] = []
        for text in texts:
            own: list = []
            parts.append(own)
            if _SEPARATORS.search(text) or any(x in text for x in self._added):
                own.append(self._plain(text))
            elif not self._spaced:
                own.append(len(stretches))
                stretches.append(text)
                spaced.append(False)
            else:
                for part, after_space in self._stretches(text):
                    if isinstance(part, bytes):
                        own.append(part)
                    else:
                        own.append(len(stretches))
                        stretches.append(part)
                        spaced.append(after_space)
        ids = self._encoded(stretches, np.array(spaced, bool))
        return [b"".join(x if isinstance(x, bytes) else ids[x] for x in own) for own in parts]

    def _stretches(self, text: str) -> Iterator[tuple[str | bytes, bool]]:
        """Stretches of words with one space or line feed between them, with whether a space before
        belongs to the first word; and the ids of white space that stands otherwise.

        Of white space before a word all but the last character is a piece, and the last one too
        unless it is a space.
        """
        if not (text[:1].isspace() or text[-1:].isspace() or any(x in text for x in _PAIRS)
                or _RARE_SPACE.search(text)):
            yield text, False
            return
        at, after_space = 0, False
        for m in _ODD.finditer(text):
            if m.start() > at:
                yield text[at:m.start()], after_space
            run, after_space, at = m[0], False, m.end()
            if at == len(text):
                yield self._piece(run), False
                break
            if len(run) > 1:
                yield self._piece(run[:-1]), False
            after_space = run[-1] == " "
            if not after_space:
                yield self._piece(run[-1]), False
        if at < len(text):
            yield text[at:], after_space

    def _encoded(self, stretches: list[str], spaced: np.ndarray) -> list[bytes]:
        """The ids of each stretch, the words of all of them taken together."""
        if not stretches:
            return []
        by_space = pc.split_pattern(pa.array(stretches, pa.large_string()), " ")
        by_line = pc.split_pattern(by_space.flatten(), "\n")
        words = by_line.flatten().dictionary_encode()
        line_starts = by_line.offsets.to_numpy()
        bounds = line_starts[by_space.offsets.to_numpy()]
        word, names = words.indices.to_numpy(), words.dictionary
        if self._spaced:
            stands = np.full(len(word), _NEW_LINE)
            stands[line_starts[:-1]] = _SPACED
            stands[bounds[:-1]] = np.where(spaced, _SPACED, _BARE)
            key = word + stands * len(names)
            used = np.zeros(3 * len(names), bool)
            used[key] = True
            number = np.cumsum(used)[key] - 1
            found = []
            for stand, own in enumerate(used.reshape(3, -1)):
                ids = self._looked_up(names.filter(pa.array(own)), stand == _SPACED)
                line_feed = self._piece("\n") if stand == _NEW_LINE else b""
                found += [line_feed + x for x in ids] if line_feed else ids
        else:
            number, found = word, self._looked_up(names, False)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        repeats = sizes[number]
        ends = np.cumsum(repeats)
        kind = np.int32 if ends[-1] < 1 << 30 and len(found) < 1 << 30 else np.int64
        place = np.repeat((starts[number] - ends + repeats).astype(kind), repeats)
        place += np.arange(ends[-1], dtype=kind)
        data = np.frombuffer(b"".join(found), "<u4")[place].tobytes()
        cuts = 4 * np.concatenate([[0], ends])[bounds]
        return [data[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _looked_up(self, pieces: pa.Array, spaced: bool) -> list[bytes]:
        """The ids of each piece, with a space in front of it or without."""
        cut = pc.utf8_rtrim(pieces, _MARKS)
        words = _strings(cut)
        found = list(map(self._words[spaced].get, words))
        other = set()
        if None in found:
            for i, word in enumerate(words):
                if found[i] is None:
                    found[i] = self._word(word, spaced)
                    if found[i] is None:
                        other.add(i)
                        found[i] = self._piece((" " if spaced else "") + pieces[i].as_py())
        marked = pc.not_equal(cut, pieces)
        for i, piece in zip(np.flatnonzero(marked).tolist(), _strings(pieces.filter(marked))):
            if i not in other:
                found[i] += self._piece(piece[len(words[i]):])
        return found

    def _word(self, word: str, spaced: bool) -> bytes | None:
        """The ids of a plain word that the newer half of the cache lacks; null for other pieces."""
        ids = self._older[spaced].get(word)
        if ids is None:
            if not (word.isascii() and word.isalpha() or _PLAIN_WORD.fullmatch(word)):
                return None
            shown = (" " + word if spaced else word).translate(self._letters)
            ids = array("I", [t.id for t in self._tokenize(shown)]).tobytes()
        if len(self._words[spaced]) >= self._most[spaced]:
            self._older[spaced], self._words[spaced] = self._words[spaced], {}
        self._words[spaced][word] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """The ids of a piece that is no plain word."""
        ids = self._other.get(piece)
        if ids is None:
            if len(self._other) >= max(10, CACHE_WORDS // 20):
                self._other.clear()
            ids = self._other[piece] = self._plain(piece)
        return ids

    def _plain(self, text: str) -> bytes:
        found = self._tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()
