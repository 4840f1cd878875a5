"""Whole-text tokenizing inside tasks with caches of the parts that texts repeat."""

from __future__ import annotations

import re
import unicodedata
from array import array

from .common import held

#: Entries after which a worker's cache starts anew, so that its memory is bounded.
CACHE_ENTRIES = 1_000_000


class WordBpe:
    """Ids of the word-end BPE tokenizer, bit for bit those of ``tokenizers``.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    space-separated parts in turn. Parts of plain Latin letters, digits and ASCII signs are cut by
    the tokenizer's own pattern and merged by its BPE model; any other part takes the full pipeline.
    """

    PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-įĲ-ňŊ-ž]*")
    CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ž]+|[0-9]|[^a-z0-9À-ÖØ-öø-ž]+")

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.full = Tokenizer.from_file(path)
        with open(path) as f:
            model = json.load(f)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bare = Tokenizer(BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix="</w>", cache_capacity=0))
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.shown = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _fill_words(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.words]
        spelled = [w if w.isascii() else "".join(map(self.shown.__getitem__, w.encode())) for w in new]
        encode = getattr(self.bare, "encode_batch_fast", self.bare.encode_batch)
        for word, got in zip(new, encode(spelled, add_special_tokens=False), strict=True):
            self.words[word] = array("I", got.ids).tobytes()

    def _fill(self, parts: list[str]) -> None:
        if self.parts and len(self.parts) + len(parts) > CACHE_ENTRIES:
            self.parts.clear()
            self.words.clear()
        plain = [p for p in parts if self.PLAIN.fullmatch(p)]
        cut = [self.CUT.findall(p) for p in plain]
        self._fill_words([w for words in cut for w in words])
        for part, words in zip(plain, cut, strict=True):
            self.parts[part] = b"".join([self.words[w] for w in words])
        rest = [p for p in parts if p not in self.parts]
        for part, got in zip(rest, self.full.encode_batch(rest, add_special_tokens=False), strict=True):
            self.parts[part] = array("I", got.ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out, cut = [], []
        for text in texts:
            if "<|" in text or "Σ" in text or "İ" in text:
                cut.append(None)
                continue
            if not text.isascii() and not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            cut.append(text.lower().replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))
        known = self.parts
        if new := [p for p in set().union(*[x for x in cut if x]) if p not in known]:
            held = len(known)
            self._fill(new)
            if len(known) < held:  # the cache began anew and lacks the older parts of these texts
                self._fill([p for p in set().union(*[x for x in cut if x]) if p not in known])
        for text, parts in zip(texts, cut, strict=True):
            if parts is None:
                out.append(array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes())
            else:
                out.append(b"".join(list(map(known.__getitem__, parts))))
        return out


class ByteBpe:
    """Ids of a byte-level BPE file of ``tokenizers``, by the faster ``tiktoken`` over the same vocabulary.

    Both merge by rank and cut by the same pattern; the file is checked on loading to be of that kind (ids in the
    order of merges, no normaliser, one special token that is matched as it stands).
    """

    def __init__(self, path: str):
        import json

        import public_tokenizers
        import tiktoken

        with open(path) as f:
            made = json.load(f)
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t["content"]: t["id"] for t in made["added_tokens"]}
        vocab, cut = made["model"]["vocab"], made["pre_tokenizer"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
        ids = [vocab[a + b] for a, b in merges]
        plain = all(not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in made["added_tokens"])
        if cut["type"] != "ByteLevel" or cut["add_prefix_space"] or made["normalizer"] or made["model"].get("ignore_merges") or not plain or ids != sorted(ids):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        ranks = {bytes(map(byte.__getitem__, piece)): i for piece, i in vocab.items() if piece not in special}
        self.path = path
        self.encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        try:
            return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
        except ValueError:  # a run of millions of spaces is more than the cutting pattern can hold
            from tokenizers import Tokenizer

            return array("I", Tokenizer.from_file(self.path).encode(text, add_special_tokens=False).ids).tobytes()


class PrefixBpe:
    """BPE with merge ranks by a table of prefixes: each prefix of a string has one last token.

    The automaton of all pieces gives the tokens that can end a prefix; the one that is compatible
    with the last token of the shorter prefix is kept, and the ids are read off backwards. Two tokens
    are compatible if merging their joined spelling by rank never crosses the border between them.
    """

    SPACE = "▁"
    RUNS = re.compile("▁+[^▁]*|[^▁]+")
    #: no piece joins characters of different kinds, but for a leading space mark (checked on loading)
    CUT = re.compile("▁*[^\\W\\d_▁²³¹]+|▁*\\d|▁*(?:[^\\w▁]|[_²³¹])+|▁+")

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.bytes = {i: int(self.pieces[i][3:5], 16) for i in range(size) if model.is_byte(i)}
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        scores = {i: model.get_score(i) for i in normal}
        self.ids = {self.pieces[i]: i for i in normal}
        self.mixed = any(len(self.CUT.findall(self.pieces[i])) > 1 for i in normal)
        self.alphabet = {self.pieces[i] for i in normal if len(self.pieces[i]) == 1}
        self.rank = {i: 0 for i in normal if len(self.pieces[i]) == 1}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.memo: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for i in self.rank:
            self.automaton.add_word(self.pieces[i], (1, i))
        merged = sorted((i for i in normal if i not in self.rank), key=lambda i: -scores[i])
        for order, i in enumerate(merged, 1):
            piece = self.pieces[i]
            for cut in range(len(piece) - 1, 0, -1):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a in self.rank and b in self.rank and self._compatible(a, b):
                    self.left[i], self.right[i], self.rank[i] = a, b, order
                    self.automaton.add_word(piece, (len(piece), i))
                    break
        self.memo.clear()
        self.automaton.make_automaton()
        self.segments: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, tuple[str, str]] = {}

    def _compatible(self, a: int, b: int) -> bool:
        rank, pieces, limit = self.rank, self.pieces, 1 << 60
        while True:
            joined = self.ids.get(pieces[a] + pieces[b])
            if joined is not None and rank.get(joined, limit) < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], self.right[a]
            elif b in self.left:
                limit, b = rank[b] + 1, self.left[b]
            else:
                return True

    def segment(self, s: str) -> tuple[int, ...]:
        """Ids of a string of known characters."""
        last, memo = [-1] * (len(s) + 1), self.memo
        for end, (length, token) in self.automaton.iter(s):
            end += 1
            if last[end] < 0:
                start = end - length
                if start:
                    pair = (last[start], token)
                    fits = memo.get(pair)
                    if fits is None:
                        fits = memo[pair] = self._compatible(*pair)
                    if not fits:
                        continue
                last[end] = token
        ids, end = [], len(s)
        while end:
            ids.append(last[end])
            end -= len(self.pieces[last[end]])
        return tuple(ids[::-1])

    def _ids(self, segment: str) -> tuple[int, ...]:
        if self.alphabet.issuperset(segment):
            return self.segment(segment)
        out, known = [], ""
        for ch in segment:
            if ch in self.alphabet:
                known += ch
                continue
            if known:
                out += self.segment(known)
                known = ""
            out += [self.byte_ids[b] for b in ch.encode()]
        return tuple(out + list(self.segment(known) if known else ()))

    def chunk(self, chunk: str) -> tuple[str, str]:
        """Of a run that starts with its space marks: decimal ids joined by commas, decoded text."""
        if len(self.chunks) >= CACHE_ENTRIES:
            self.chunks.clear()
            self.segments.clear()
        ids: list[int] = []
        for part in [chunk] if self.mixed else self.CUT.findall(chunk):
            got = self.segments.get(part)
            if got is None:
                got = self.segments[part] = self._ids(part)
            ids += got
        return ",".join(map(str, ids)), self.decode(ids)

    def decode(self, ids) -> str:
        """Text of ids; runs of byte tokens are read as UTF-8."""
        out, held = [], bytearray()
        for i in ids:
            if i in self.bytes:
                held.append(self.bytes[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            out.append(self.pieces[i])
        return ("".join(out) + held.decode("utf-8", "replace")).replace(self.SPACE, " ")

    def encode(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by commas, and what they decode to."""
        if not text:
            return "", ""
        space = self.SPACE
        if text[0] == " " or "  " in text or space in text:
            chunks = self.RUNS.findall(space + text.replace(" ", space))
        else:
            chunks = [space + w for w in text.split(" ")]
        cache = self.chunks
        try:
            got = list(map(cache.__getitem__, chunks))
        except KeyError:
            got = []
            for c in chunks:
                x = cache.get(c)
                if x is None:
                    x = self.chunk(c)
                    cache[c] = x
                got.append(x)
        ids, texts = zip(*got, strict=True)
        return ",".join(ids), "".join(texts)[1:]


def loaded(kind: type, path: str):
    """One instance a worker process; later tasks of the worker find its caches warm."""
    return held((kind, path), lambda: kind(path))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
