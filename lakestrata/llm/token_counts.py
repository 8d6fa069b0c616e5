"""Token counts: greedy longest-match word pieces, counted by a linear automaton.

The vocabulary becomes a trie whose nodes carry a failure link and the
number of pieces popped when the link is taken, so a word's piece count
is a sum along one walk: no piece is built and no character is read twice.
Words seen in a batch are walked together, one numpy step per character
position, and a bounded memo keeps the counts of words.  A word of more than
LONG_WORD bytes is walked by itself, symbol by symbol, and not kept.

Texts are lower-cased and cut into runs of letters, single digits and runs of
other characters than white space; a word's last byte is its word-end symbol.
A word that no sequence of greedy pieces covers counts as one (unknown)
token.  Null or empty texts: zero words and tokens.  Very long texts are read
in pieces cut at white space; repeated rows are counted each by itself; empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
WORDS = r"[^\W\d_]+|\d|(?:[^\w\s]|_)+"
SYMBOLS = 512  # a byte, and a byte that ends its word
MEMO_WORDS = 300_000
WALK_WORDS = 20_000
LONG_WORD = 256


@dataclass
class Automaton:
    keys: np.ndarray  # sorted node * SYMBOLS + symbol
    to: np.ndarray  # the child of each key
    fail: np.ndarray  # -1: none
    popped: np.ndarray
    plain: tuple | None = None  # the same as a dictionary and lists, made for the first long word


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: printable bytes as they are, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str = DEFAULT_VOCABULARY) -> list[tuple[int, ...]]:
    """Pieces as symbol sequences from a tokenizer file with word-end suffixes."""
    model = json.load(open(path, encoding="utf-8"))["model"]
    suffix, alphabet = model.get("end_of_word_suffix") or "", byte_alphabet()
    pieces = set()
    for token in model["vocab"]:
        ends = bool(suffix) and token.endswith(suffix)
        body = token[: -len(suffix)] if ends else token
        if body and all(c in alphabet for c in body):
            symbols = [alphabet[c] for c in body]
            pieces.add((*symbols[:-1], symbols[-1] + 256 * ends))
    return sorted(pieces)


def build(pieces: list[tuple[int, ...]]) -> Automaton:
    children: list[dict[int, int]] = [{}]
    token = [False]
    for piece in pieces:
        v = 0
        for s in piece:
            v = children[v].setdefault(s, len(children))
            if v == len(children):
                children.append({})
                token.append(False)
        token[v] = True
    fail, popped = [-1] * len(children), [0] * len(children)
    level = [0]
    while level:  # breadth first: a link leads to a shorter string
        below = []
        for u in level:
            for s, v in children[u].items():
                below.append(v)
                if token[v]:
                    fail[v], popped[v] = 0, 1
                    continue
                z, n = fail[u], popped[u]
                while z >= 0 and s not in children[z]:
                    n += popped[z]
                    z = fail[z]
                if z >= 0:
                    fail[v], popped[v] = children[z][s], n
        level = below
    edges = sorted((u * SYMBOLS + s, v) for u, c in enumerate(children) for s, v in c.items())
    keys, to = np.array(edges, np.int64).reshape(-1, 2).T.copy()
    return Automaton(keys, to.astype(np.int32), np.array(fail, np.int32), np.array(popped, np.int32))


def step(a: Automaton, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The child of each state by its symbol, -1 where there is none."""
    key = state.astype(np.int64) * SYMBOLS + symbol
    at = np.minimum(np.searchsorted(a.keys, key), len(a.keys) - 1)
    return np.where(a.keys[at] == key, a.to[at], -1) if len(a.keys) else np.full(len(key), -1)


def count_long(a: Automaton, word: bytes) -> int:
    """Pieces of one word, symbol by symbol."""
    if a.plain is None:
        a.plain = dict(zip(a.keys.tolist(), a.to.tolist(), strict=True)), a.fail.tolist(), a.popped.tolist()
    edges, fail, popped = a.plain
    count = state = 0
    for symbol in (*word[:-1], word[-1] + 256):
        while (to := edges.get(state * SYMBOLS + symbol)) is None:
            if fail[state] < 0:
                return 1
            count, state = count + popped[state], fail[state]
        state = to
    while state:
        if fail[state] < 0:
            return 1
        count, state = count + popped[state], fail[state]
    return count


def count_words(a: Automaton, words: list[str]) -> np.ndarray:
    """Pieces of each word; all words of up to LONG_WORD bytes take a step at the same time."""
    if any(len(w) * 4 > LONG_WORD for w in words):
        size = np.array([len(w.encode("utf-8", "surrogatepass")) for w in words])
        out, short = np.zeros(len(words), np.int64), np.flatnonzero(size <= LONG_WORD)
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            out[i] = count_long(a, words[i].encode("utf-8", "surrogatepass"))
        if len(short):
            out[short] = _count_together(a, [words[i] for i in short.tolist()])
        return out
    return _count_together(a, words)


def _count_together(a: Automaton, words: list[str]) -> np.ndarray:
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    size = np.array([len(r) for r in raw], np.int64)
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    data[start + size - 1] += 256
    count = np.zeros(len(words), np.int64)
    state = np.zeros(len(words), np.int64)
    known = np.ones(len(words), bool)
    order = np.argsort(-size, kind="stable")
    live_at = np.searchsorted(-size[order], -np.arange(1, int(size.max()) + 1), "right")
    for t in range(int(size.max())):
        todo = order[: live_at[t]]
        todo = todo[known[todo]]
        symbol = data[start[todo] + t]
        while len(todo):
            to = step(a, state[todo], symbol)
            ok = to >= 0
            state[todo[ok]] = to[ok]
            todo, symbol = todo[~ok], symbol[~ok]
            f = a.fail[state[todo]]
            lost = f < 0
            known[todo[lost]] = False
            todo, symbol, f = todo[~lost], symbol[~lost], f[~lost]
            count[todo] += a.popped[state[todo]]
            state[todo] = f
    todo = np.flatnonzero(known)
    while len(todo := todo[state[todo] != 0]):
        f = a.fail[state[todo]]
        known[todo[f < 0]] = False
        todo, f = todo[f >= 0], f[f >= 0]
        count[todo] += a.popped[state[todo]]
        state[todo] = f
    return np.where(known, count, 1)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | list = DEFAULT_VOCABULARY) -> DataFrame:
    """id_col, n_words, n_tokens of every row's whole text.

    The automaton that is broadcast grows with the vocabulary only (about 20
    bytes a trie node).
    """
    pieces = load_vocabulary(vocabulary) if isinstance(vocabulary, str) else vocabulary
    a = build(pieces)
    shared = docs.sparkSession.sparkContext.broadcast((a.keys, a.to, a.fail, a.popped))
    thin = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))

    def run(batches):
        automaton, memo, find = Automaton(*shared.value), {}, re.compile(WORDS)
        for b in batches:
            words, tokens = [], []
            for t in b.column(1):
                n = m = 0
                text = t.as_py() or ""
                for k, piece in enumerate_pieces(text):
                    found = find.findall(piece.lower())
                    n += len(found)
                    new = list(set(found).difference(memo))
                    if len(memo) + len(new) > MEMO_WORDS:
                        memo = {}
                        new = list(set(found))
                    for i in range(0, len(new), WALK_WORDS):
                        part = new[i : i + WALK_WORDS]
                        memo.update(zip(part, count_words(automaton, part).tolist(), strict=True))
                    m += sum(map(memo.__getitem__, found))
                    for w in new:
                        if len(w) > LONG_WORD:
                            del memo[w]
                words.append(n)
                tokens.append(m)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], [id_col, "n_words", "n_tokens"])

    return thin.mapInArrow(run, f"`{id_col}` {thin.schema[id_col].dataType.simpleString()}, n_words long, n_tokens long")


def enumerate_pieces(text: str, limit: int = 1 << 20):
    """The text in parts cut at white space, so that very long texts need little memory."""
    k = i = 0
    while i < len(text):
        j = min(len(text), i + limit)
        while j < len(text) and not text[j].isspace():
            j += 1
        yield k, text[i:j]
        i, k = j, k + 1
