"""Whole texts to token ids with public tokenizers, each word of a slice of texts encoded once."""

import codecs
import functools
import re
import string
import unicodedata
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: Between two words lies a single space. Neither tokenizer file joins tokens across it: a pre-token holds a space only
#: as its first character or within a run of white space, and added tokens hold none. So texts may be cut before it.
CUT = re.compile(r" (?<=\S )(?=\S)")

#: White space other than space and line feed; a text without it needs no pattern to be cut.
OTHER_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
#: White space that a word among others may not hold: with line feeds inside it alone, its only token that starts with
#: a space is still its first.
ODD_SPACE = re.compile(r"[^\S\n]|\n\Z")
#: What is white space here but not in the tokenizer files.
SEPARATORS = "\x1c\x1d\x1e\x1f"

#: Words whose ids a task keeps: once there are so many, only those that come again before there are so many anew stay.
KEPT_WORDS = 300_000
#: Text bytes encoded at once: the more, the fewer look-ups of words that come again.
TEXT_BYTES = 4 << 20
#: Words that the library gets at once.
AT_ONCE = 512

#: Byte-level tokens show bytes that are not printable as the characters from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTES = dict(zip([b for b in range(256) if b not in _SHOWN], map(chr, range(256, 512)), strict=False))
#: The character of each byte.
ALL_BYTES = "".join(BYTES.get(b, chr(b)) for b in range(256))


@functools.lru_cache(maxsize=2)
def encoder(file):
    """The encoder of a file that the tasks of a worker share, with the words it has learned."""
    return Encoder(file)


def cut(text):
    """What comes before the first cut, and the rest: a text to be cut at each space, or the pieces themselves where
    some hold spaces. All but the first have lost the space before them."""
    if (
        "  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " "
        or any(c in text for c in OTHER_SPACE)
    ):
        head, *pieces = CUT.split(text)
        return head, pieces
    head, space, rest = text.partition(" ")
    return head, rest if space else []


def strings(array):
    """The strings of an Arrow array, none null; read as one where none holds a space."""
    if array.nbytes > 1 << 30:
        return array.to_pylist()
    whole = pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array)
    out = pc.binary_join(whole, " ")[0].as_py().split(" ")
    return out if len(out) == len(array) else array.to_pylist()


class Encoder:
    """Encodes texts as ``tokenizers`` does with ``add_special_tokens=False``.

    A text is cut before single spaces; the library encodes each distinct piece, and the ids of a text are those of its
    pieces in a row. Special strings inside texts become special ids, as is the library's default.
    """

    def __init__(self, file, kept=KEPT_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
        self.kept = kept
        # The words of late, and those before them.
        self.words, self.before = {"": b""}, {}
        # Marks in the vocabulary: a byte-level token that starts with a space, a token that ends a word.
        size = self.tokenizer.get_vocab_size()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.ends = np.array([x.endswith("</w>") for x in tokens])
        self.starts = np.array([x.startswith("Ġ") for x in tokens])
        self.by_end = bool(self.ends.any())
        # Ids of marks that are, in a row after letters, a pre-token of their own.
        self.stop_ids = functools.lru_cache(maxsize=10_000)(self.head)

    def is_stem(self, word):
        """Whether marks after it are a pre-token of their own: letters, unless they become letters and marks, or a line
        feed, alone or with letters."""
        if self.by_end:
            return word.isalpha() and word == word.lower() and (word.isascii() or unicodedata.is_normalized("NFC", word))
        return word.isalpha() or word[:1] == "\n" and (len(word) == 1 or word[1:].isalpha())

    def ids_of(self, words):
        """The ids of each word with a space before it or the line feed that it starts with.

        Words of letters are one pre-token; where no normalisation changes them, they go straight to the model.
        Others are encoded together as one text and told apart by the marks of the vocabulary, which is safe for words
        without white space but line feeds or, where the end of a word is marked, of letters alone; or else by the
        tokens' offsets.
        """
        by_end, plain, marked, other, table = self.by_end, [], [], [], {}
        for w in words:
            if w.isalpha():
                same = not by_end or w.islower() and (w.isascii() or unicodedata.is_normalized("NFC", w))
                (plain if same else marked).append(w)
            elif w[:1] == "\n":
                if w[1:].isalpha():
                    plain.append(w)
                else:
                    table[w] = self.stop_ids("\n") + self.head(w[1:])
            elif by_end or ODD_SPACE.search(w):
                other.append(w)
            else:
                marked.append(w)
        for each, how in ((plain, self._plain), (marked, self._marked), (other, self._by_offset)):
            table.update(zip(each, how(each), strict=True))
        return table

    def _plain(self, words):
        tokenize, first, feed = self.tokenizer.model.tokenize, "" if self.by_end else "Ġ", self.stop_ids("\n")
        for w in words:
            line = w[0] == "\n"
            shown = w[1:] if line else w
            if not shown.isascii():
                shown = codecs.charmap_decode(shown.encode(), "strict", ALL_BYTES)[0]
            ids = array("I", [x.id for x in tokenize(shown if line else first + shown)]).tobytes()
            yield feed + ids if line else ids

    def _marked(self, words):
        for first in range(0, len(words), AT_ONCE):
            part = words[first : first + AT_ONCE]
            found = self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype="<u4")
            if self.by_end:
                bounds = np.concatenate(([0], np.flatnonzero(self.ends[ids]) + 1))
            else:
                bounds = np.concatenate((np.flatnonzero(self.starts[ids]), [len(ids)]))
            if len(bounds) != len(part) + 1 or bounds[0] != 0 or bounds[-1] != len(ids):
                yield from self._by_offset(part)
                continue
            packed, bounds = ids.tobytes(), (4 * bounds).tolist()
            yield from (packed[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))

    def _by_offset(self, words):
        """A token belongs to the word in which it starts."""
        for first in range(0, len(words), AT_ONCE):
            part = words[first : first + AT_ONCE]
            starts = np.cumsum([0] + [len(w) + 1 for w in part])
            found = self.tokenizer.encode(" " + " ".join(part), add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4")
            bounds = np.searchsorted([a for a, _ in found.offsets], starts).tolist()
            yield from (ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True))

    def pieces(self, text):
        """The first piece, with whatever stands before it, and the rest as ``cut`` gives it. White space itself has no
        tokens where the end of a word is marked, so there more cuts are safe, and pieces may be empty. That file composes
        letters and marks and then lower-cases letters one by one, as ``lower`` does but for two of them; special
        strings are left as they are. Where its own normaliser would change what it has made of a text, the text goes
        to the library whole."""
        if not self.by_end:
            return cut(text)
        made = text
        if any(x in text for x in ("Σ", "İ", "<|")):
            if not unicodedata.is_normalized("NFC", text):
                return text, []
        elif unicodedata.is_normalized("NFC", text):
            made = text.lower()
        else:
            made = self.tokenizer.normalizer.normalize_str(text)
        if made is not text and not unicodedata.is_normalized("NFC", made):
            return text, []
        if any(c in made for c in SEPARATORS):
            return cut(made)
        return "", " ".join(made.split()) if any(c in made for c in OTHER_SPACE) else made.replace("\n", " ")

    def head(self, piece):
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, dtype="<u4").tobytes() if piece else b""

    def look_up(self, words):
        """The ids of distinct words."""
        out = [*map(self.words.get, words)]
        missing = [k for k, ids in enumerate(out) if ids is None]
        names = [words[k] for k in missing]
        again = {w: ids for w in names if (ids := self.before.get(w)) is not None} if self.before else {}
        here = again | self.ids_of([w for w in names if w not in again])
        self.words.update(here)
        for k, w in zip(missing, names, strict=True):
            out[k] = here[w]
        return out

    def joined(self, words):
        """The ids of distinct words, put together from stems and the marks after them. Words are cut before line feeds,
        which begin pre-tokens where there are at most two in a row, not before a special string, and no other white space is
        beside them."""
        lists = pc.split_pattern(pc.replace_substring(words, "\n", " \n"), " ")
        parts, at = lists.flatten(), lists.offsets.to_numpy()
        trimmed = pc.utf8_rtrim(parts, characters=string.punctuation)
        stems = trimmed.dictionary_encode()
        names = strings(stems.dictionary)
        good = np.fromiter(map(self.is_stem, names), bool, len(names))
        pool = self.look_up([w for w, x in zip(names, good.tolist(), strict=True) if x])
        index = stems.indices.to_numpy()
        is_good = good[index]
        # Two columns: the stem, or the part as it is, and the marks.
        picks = np.empty((len(parts), 2), np.int64)
        picks[:, 0] = (np.cumsum(good) - 1)[index]
        whole = parts.filter(pa.array(~is_good)).dictionary_encode()
        picks[~is_good, 0] = len(pool) + whole.indices.to_numpy()
        pool += self.look_up(strings(whole.dictionary))
        picks[:, 1] = len(pool)
        pool.append(b"")
        length = pc.binary_length(trimmed).to_numpy()
        marked = np.flatnonzero(is_good & (length != pc.binary_length(parts).to_numpy()))
        if len(marked):
            ends = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset :]
            bounds = np.stack((ends[marked] + length[marked], ends[marked + 1]), axis=1).ravel()
            marks = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), parts.buffers()[2])
            marks = marks.take(pa.array(np.arange(0, len(marks), 2))).dictionary_encode()
            picks[marked, 1] = len(pool) + marks.indices.to_numpy()
            pool += map(self.stop_ids, marks.dictionary.to_pylist())
        ids = pa.array(pool, pa.large_binary()).take(pa.array(picks.ravel()))
        _, ends, packed = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[ids.offset :][2 * at]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), packed or pa.py_buffer(b"")])

    def word_ids(self, words, spaced):
        """The ids of distinct words; ``spaced`` says that some may hold white space other than line feeds."""
        odd = functools.reduce(pc.or_, [pc.ends_with(words, "\n\n"), *(pc.match_substring(words, x) for x in ("\n\n\n", "\n\n<|"))])
        if spaced:
            odd = pc.or_(odd, pc.match_substring_regex(words, f"[ {OTHER_SPACE}" + "\n" * self.by_end + "]"))
        if not pc.any(odd).as_py():
            return self.joined(words)
        usual = pc.invert(odd)
        ids = [self.joined(words.filter(usual)), pa.array(self.look_up(words.filter(odd).to_pylist()), pa.large_binary())]
        order = np.concatenate([np.flatnonzero(x.to_numpy(zero_copy_only=False)) for x in (usual, odd)])
        return pa.concat_arrays(ids).take(pa.array(np.argsort(order)))

    def encode(self, texts):
        """The ids of each text as bytes, four for an id."""
        if len(self.words) > self.kept:
            self.words, self.before = {"": b""}, self.words
        split = [self.pieces(x) for x in texts]
        # Arrow cuts the texts and numbers their words; what some texts are cut into here comes after.
        lists = pc.split_pattern(pa.array([x if isinstance(x, str) else None for _, x in split], pa.string()), " ")
        bounds = lists.offsets.to_numpy()
        cuts = np.stack((bounds[:-1], bounds[1:]), axis=1)
        words, heads, more, spaced = lists.flatten(), [], [], False
        for k, (head, rest) in enumerate(split):
            if not isinstance(rest, str):
                cuts[k] = len(words) + len(more), len(words) + len(more) + len(rest)
                more += rest
                spaced = spaced or bool(rest)
            elif head and not self.by_end and head[0] != "\n" and "\n\n" not in head:
                # A first word as after a line feed, whose own id goes.
                heads.append((k, len(words) + len(more)))
                more.append("\n" + head)
        words = pa.concat_arrays([words, pa.array(more, pa.string())]).dictionary_encode()
        ids = self.word_ids(words.dictionary, spaced).take(words.indices)
        _, ends, packed = ids.buffers()
        ends, packed = np.frombuffer(ends, np.int64)[ids.offset :], packed.to_pybytes() if packed else b""
        feed, first = len(self.stop_ids("\n")), {k: packed[ends[at] : ends[at + 1]] for k, at in heads}
        return [
            (first[k][feed:] if k in first else self.head(split[k][0])) + packed[a:b] for k, (a, b) in enumerate(ends[cuts].tolist())
        ]
