"""Byte-pair encoding of words, shared by the token operators.

``WordBpe`` reads a vocabulary file's JSON. A word is first proposed as greedy
longest-match tokens; the proposal is the true encoding exactly if each token
encodes itself and each adjacent pair of tokens encodes to just that pair. All
pairs of a batch of words are looked up at once; only words with a failing pair
go through exact merging (lowest rank first, leftmost on ties, by heap and
linked list).
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space as the tokenizers' patterns see it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed patterns of the two vocabularies.
BYTE_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next one from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


CHARS = byte_chars()
LATIN = {b: CHARS[b] for b in range(256)}


def as_chars(data: bytes) -> str:
    return data.decode("latin-1").translate(LATIN)


def merge(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The symbols after all merges: again and again the lowest-ranked adjacent pair, the leftmost of equals."""
    n = len(symbols)
    if n < 2:
        return symbols
    ids = list(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    get = ranks.get
    heap = [(r[0], k, ids[k], ids[k + 1], r[1]) for k in range(n - 1) if (r := get((ids[k], ids[k + 1])))]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, k, a, b, new = pop(heap)
        nxt = after[k]
        if ids[k] != a or nxt < 0 or ids[nxt] != b:
            continue
        ids[k], ids[nxt] = new, -1
        after[k] = far = after[nxt]
        if far >= 0:
            before[far] = k
            if r := get((new, ids[far])):
                push(heap, (r[0], k, new, ids[far], r[1]))
        if (left := before[k]) >= 0 and (r := get((ids[left], new))):
            push(heap, (r[0], left, ids[left], new, r[1]))
    return [x for x in ids if x >= 0]


def merges_done(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many merges ``symbols`` undergo."""
    return len(symbols) - len(merge(symbols, ranks))


class WordBpe:
    """Encoder of single words over one vocabulary."""

    def __init__(self, source: bytes | str):
        spec = json.loads(source)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        ids = self.vocab
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(ids[a], ids[b]): (k, ids[a + b]) for k, (a, b) in enumerate(pairs)}
        self.longest = max(map(len, self.vocab))
        base = sorted(set(ids.values()) - {r[1] for r in self.ranks.values()})
        size = max(self.tokens) + 1
        place = np.full(size, -1, np.int64)
        place[base] = np.arange(len(base))
        made = np.array([r[1] for r in self.ranks.values()], np.int64)
        place[made] = len(base) + np.arange(len(made))
        self.place = place
        left, right = (np.array([p[k] for p in self.ranks], np.int64) for k in (0, 1))
        count = len(base) + len(made)
        self.first, self.last = np.arange(count), np.arange(count)
        self.first[place[made]], self.last[place[made]] = place[left], place[right]
        keys = (place[left] << 20) | place[right]
        order = np.argsort(keys)
        self.keys, self.result = keys[order], place[made][order]
        self.base = len(base)
        self.sound: dict[int, bool] = {}
        self.byte_id = [ids.get(c, -1) for c in CHARS]
        self.odd: set[str] = set()
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.stats = {"words": 0, "merged": 0}

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text between special strings, and each special string's id."""
        at = 0
        if self.split and "<|" in text:
            for m in self.split.finditer(text):
                yield text[at : m.start()], None
                yield "", self.special[m[0]]
                at = m.end()
        yield text[at:] if at else text, None

    def symbols(self, chars: str, final: bool = True) -> list[int]:
        vocab = self.vocab
        if not chars:
            return []
        return [vocab[c] for c in chars[:-1]] + [vocab[chars[-1] + (self.end if final else "")]]

    def exact(self, chars: str) -> list[int]:
        return merge(self.symbols(chars), self.ranks)

    def token_symbols(self, token: int) -> list[int]:
        t = self.tokens[token]
        final = bool(self.end) and t.endswith(self.end)
        return self.symbols(t[: len(t) - len(self.end)] if final else t, final)

    def greedy(self, chars: str) -> list[int]:
        """Longest vocabulary entries from left to right; one with the word-end mark only at the end."""
        whole = chars + self.end
        vocab, n, out, at = self.vocab, len(whole), [], 0
        last = len(chars)
        while at < last:
            if n - at <= self.longest and (t := vocab.get(whole[at:])) is not None:
                out.append(t)
                break
            for e in range(min(last, at + self.longest) if not self.end else min(last - 1, at + self.longest), at, -1):
                if (t := vocab.get(whole[at:e])) is not None:
                    out.append(t)
                    at = e
                    break
            else:
                out.append(vocab[whole[at:]])
                break
        return out

    def token_sound(self, t: int) -> bool:
        if (ok := self.sound.get(t)) is None:
            ok = self.sound[t] = merge(self.token_symbols(t), self.ranks) == [t]
        return ok

    def pairs_sound(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of each pair of tokens: whether merging their symbols side by side gives just the two again.

        Both sides are taken apart at the seam, the later merge first; a merge
        across the seam that comes before the merge just undone would have won.
        """
        x, y = self.place[a], self.place[b]
        out = np.ones(len(x), bool)
        limit = np.full(len(x), np.iinfo(np.int64).max)
        live = np.arange(len(x))
        while len(live):
            keys = (x << 20) | y
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            lost = (self.keys[at] == keys) & (self.result[at] < limit)
            out[live[lost]] = False
            x, y, limit, live = (v[~lost] for v in (x, y, limit, live))
            by_x = (x >= self.base) & ((x > y) | (y < self.base))
            by_y = ~by_x & (y >= self.base)
            limit = np.where(by_x, x, np.where(by_y, y + 1, limit))
            x, y = np.where(by_x, self.last[x], x), np.where(by_y, self.first[y], y)
            go = by_x | by_y
            x, y, limit, live = (v[go] for v in (x, y, limit, live))
        return out

    def encode_words(self, words: Iterable[str]) -> list[list[int]]:
        """Ids of each word (in byte characters): speculate, verify all pairs, merge the words that fail."""
        words = list(words)
        proposed = [self.greedy(w) for w in words]
        sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        failed = np.zeros(len(words), bool)
        tokens, at = np.unique(flat, return_inverse=True)
        sound = np.fromiter(map(self.token_sound, tokens.tolist()), bool, len(tokens))
        failed[owner[~sound[at]]] = True
        if len(flat) > 1:
            inside = owner[1:] == owner[:-1]
            keys, at = np.unique((flat[:-1][inside] << 20) | flat[1:][inside], return_inverse=True)
            sound = self.pairs_sound(keys >> 20, keys & 0xFFFFF)
            failed[owner[1:][inside][~sound[at]]] = True
        for k in np.flatnonzero(failed).tolist():
            proposed[k] = self.exact(words[k])
        self.stats["words"] += len(words)
        self.stats["merged"] += int(failed.sum())
        return proposed


FIND_WORDS = regex.compile(WORD_PATTERN)
FIND_BYTES = regex.compile(BYTE_PATTERN)


def folded(text: str) -> str:
    """Composed form, lower case character by character (no special final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def too_new(text: str) -> bool:
    """Whether the text has a character that this Python's Unicode tables lack: the pattern libraries may class it differently."""
    return not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text))


ANY_SPACE = regex.compile(f"[{SPACE}]")
#: Characters encoded together: a text is cut at white space into pieces of about so many.
PIECE = 8_000_000


class ChunkCodec:
    """Ids of whole texts, by way of the ids of their chunks: runs without white space of ASCII.

    No word reaches over white space, so a chunk's ids depend on the chunk alone
    (one with wider spaces inside has several words like any other).
    Chunks met lately are kept in one table: at most ``entries`` of them or
    ``most`` bytes of keys, then it starts anew; a batch is encoded in pieces, so the
    table never holds more than that and one piece's. ``word_ids`` encodes words.
    """

    def __init__(self, source: bytes, word_ids, entries: int = 600_000, most: int = 48 << 20):
        self.source = source
        self.bpe = WordBpe(source)
        self.word_ids = word_ids
        self.entries, self.most = entries, most
        self.kind = np.dtype("<u2" if max(self.bpe.tokens) < 1 << 16 else "<u4")
        self._library = None
        self.clear()

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.source.decode())
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.held = 0
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, self.kind), 0
        # Entries with a character that the pattern library may class differently.
        self.odd: set[int] = set()
        # Folded texts have no capital letter of ASCII, so these never meet a chunk.
        self.add([f"S{i}" for i in self.bpe.special.values()], np.array(list(self.bpe.special.values()), self.kind), np.ones(len(self.bpe.special), np.int64))

    def add(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, m, end = len(self.index), len(chunks), self.used + len(ids)
        if n + m > len(self.starts):
            room = max(2 * len(self.starts), n + m)
            self.starts, self.sizes = (np.concatenate([x[:n], np.zeros(room - n, np.int64)]) for x in (self.starts, self.sizes))
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(len(self.flat), len(ids)), self.kind)])
        self.flat[self.used : end] = ids
        self.starts[n : n + m] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n : n + m] = sizes
        self.used = end
        self.index.update(zip(chunks, range(n, n + m), strict=True))
        self.held += sum(map(len, chunks))

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of entries one after the other, and how many each has."""
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[codes] - ends + sizes, sizes)
        return self.flat[shift + np.arange(len(shift))], sizes

    def learn(self, chunks: list[str]) -> None:
        """Enter chunks: their words first, in one batch, then those that are no single word."""
        index = self.index
        composed = [(c, FIND_WORDS.findall(c)) for c in chunks if not c.isalpha()]
        words = set(filter(str.isalpha, chunks))
        words.update(w for _, own in composed for w in own if w not in index)
        if words:
            new = list(words)
            self.add(new, *self.word_ids(self, new))
        rest = [(c, own) for c, own in composed if c not in index]
        if rest:
            counts = np.fromiter((len(own) for _, own in rest), np.int64, len(rest))
            ids, sizes = self.gather(np.fromiter((index[w] for _, own in rest for w in own), np.int64, int(counts.sum())))
            upto = np.r_[0, np.cumsum(sizes)]
            ends = np.cumsum(counts)
            self.add([c for c, _ in rest], ids, upto[ends] - upto[ends - counts])
        if too_new("".join(chunks)):
            self.odd.update(index[c] for c in chunks if too_new(c))

    def folded(self, text: str) -> str:
        """Chunks of a text between white space of ASCII; special strings are chunks of their own."""
        parts = [folded(part) if special is None else f"S{special}" for part, special in self.bpe.parts(text)]
        return parts[0] if len(parts) == 1 else " ".join(parts)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > self.entries or self.held > self.most:
            self.clear()
        lists = pc.ascii_split_whitespace(pa.array(list(map(self.folded, texts)), pa.large_string()))
        found = lists.values.dictionary_encode()
        own = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        get = self.index.get
        # The empty string stands before and after white space at a text's ends.
        self.learn([c for c in own if get(c) is None])
        table = np.fromiter(map(self.index.__getitem__, own), np.int64, len(own))
        codes = table[found.indices.to_numpy()] if len(own) else np.zeros(0, np.int64)
        ids, sizes = self.gather(codes)
        upto = np.r_[0, np.cumsum(sizes)]
        return ids, upto[lists.offsets.to_numpy()], codes, lists.offsets.to_numpy()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = []
        batch: list[str] = []
        size = 0

        def done() -> None:
            nonlocal batch, size
            ids, ends, codes, places = self._encode(batch)
            odd = np.zeros(0, np.int64)
            if self.odd:
                odd = np.unique(np.searchsorted(places, np.flatnonzero(np.isin(codes, list(self.odd))), side="right") - 1)
            again = set(odd.tolist())
            for k, t in enumerate(batch):
                out.append(np.array(self.library.encode(t, add_special_tokens=False).ids, self.kind) if k in again else ids[ends[k] : ends[k + 1]])
            batch, size = [], 0

        for text in texts:
            text = text or ""
            if len(text) > 2 * PIECE:
                if batch:
                    done()
                out.append(self.long(text))
                continue
            batch.append(text)
            size += len(text)
            if size >= PIECE:
                done()
        if batch:
            done()
        return out

    def long(self, text: str) -> np.ndarray:
        """The ids of a text taken in pieces that end before white space."""
        if too_new(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind)
        parts, at = [], 0
        while at < len(text):
            cut = len(text) if len(text) - at <= PIECE else next((m.start() for m in ANY_SPACE.finditer(text, at + PIECE)), len(text))
            parts.append(self._encode([text[at:cut]])[0])
            at = cut
        return np.concatenate(parts)


class Cache(dict):
    """A dict that keeps what was used lately: when full, the younger half replaces the older."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit // 2, {}

    def turn(self) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()

    def lacking(self, keys: Iterable[str]) -> list[str]:
        """Those of the keys that have to be made; others are brought from the older half."""
        out, old = [], self.old
        for k in set(keys).difference(self):
            if (v := old.get(k)) is None:
                out.append(k)
            else:
                self[k] = v
        return out
