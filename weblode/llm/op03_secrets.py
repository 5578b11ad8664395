"""Secret scans: fixed patterns, and a linear-chain conditional random field
that tags tokens as begin, inside or outside of a secret, decoded by Viterbi.

The field is to find what the patterns do not. It therefore does not learn from
their hits as they are alone: in copies of each the key word and the value are
replaced, and secrets and look-alikes are put into texts that have neither.
"""

from __future__ import annotations

import heapq
import random
import re
import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weblode.llm.common import blank, mix64, read_table, share_code, slices, text_buffer
from weblode.llm.words import chars_before, hash_words

NAME = "op3_secrets"

# The patterns of the contract, in report order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")

#: Texts with a secret, and as many others, that the tagger is fitted on at most;
#: characters that are taken of each, on both sides of a place; tokens of a
#: window; passes over all.
SAMPLE_TEXTS, AROUND, WIDTH, EPOCHS = 1000, 120, 40, 40
#: Parts in which the sample is drawn from what tasks kept, before the last draw.
PARTS = 64
#: Copies of each text without a secret that get a made one.
MADE = 3
#: Slots of the weight table and the shortest span that the tagger adds.
SLOTS, LEAST_CHARS = 1 << 16, 8
BEGIN, INSIDE, OUTSIDE = 0, 1, 2

# Names that values are given, in training texts that are made.
KEYS = (
    "access_key", "auth", "authorization", "client_secret", "code", "credential", "key", "login", "pass",
    "passphrase", "pin", "private_key", "pwd", "session", "sig", "signature", "user_key",
)
# Words that a pattern of the contract needs, lower-cased.
_ASSIGN_WORDS = ("passw", "secret", "token", "api")

_SPANS = "array<struct<kind:string,start:int,end:int>>"


# --- fixed patterns ----------------------------------------------------------


def base_spans(text: str, long_hex: bool = True) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the secret itself) of the fixed patterns."""
    found = []
    low = text.lower() if ":" in text or "=" in text else ""
    if any(word in low for word in _ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if long_hex:
        found += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# --- tokens and their features -------------------------------------------------

_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_SYMBOL = np.isin(_BYTES, list(b"+/_.-"))
_HEX = _DIGIT | ((_BYTES >= 97) & (_BYTES <= 102))
_WORD = _DIGIT | _UPPER | _LOWER | _SYMBOL | (_BYTES >= 128)
_GAP = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_LENGTHS = np.array([2, 3, 4, 6, 8, 12, 16, 20, 24, 28, 40])
#: Letters without case, digits, signs, bytes beyond ASCII, others.
_LETTER = np.full(256, 29)
_LETTER[97:123], _LETTER[65:91], _LETTER[_DIGIT], _LETTER[_SYMBOL], _LETTER[128:] = range(26), range(26), 26, 27, 28
_CASE = _DIGIT * 1 + _UPPER * 2 + _LOWER * 3
#: How unlikely the letters of a token follow each other, in nats a letter.
_SURPRISES = np.array([1.5, 2.0, 2.4, 2.7, 3.0, 3.3, 3.7, 4.2])
NO_SURPRISE = np.zeros((30, 30), np.float32)


class Tokens(NamedTuple):
    """Runs of word characters, and other signs one by one, of many texts."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def tokens(raw: np.ndarray, at: np.ndarray) -> Tokens:
    word, gap = _WORD[raw], _GAP[raw]
    begins = ~gap
    begins[1:] &= ~(word[1:] & word[:-1])
    heads = at[:-1][at[:-1] < len(raw)]
    begins[heads] = ~gap[heads]
    start = np.flatnonzero(begins)
    # a run ends where the next byte is no word byte, or another text begins
    stop = np.ones(len(raw) + 1, bool)
    stop[1:-1] = ~(word[1:] & word[:-1])
    stop[at] = True
    stops = np.flatnonzero(stop)
    end = stops[np.searchsorted(stops, start, side="right")]
    return Tokens(start, end, np.searchsorted(start, at))


def surprise_of(texts: list[str]) -> np.ndarray:
    """-log of how often one letter is followed by another in ``texts``."""
    letters = _LETTER[text_buffer(pa.array(texts, pa.string()))[0]]
    counts = np.bincount(letters[:-1] * 30 + letters[1:], minlength=900).reshape(30, 30) + 0.5
    return -np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def odd_share(found: Tokens, raw: np.ndarray) -> np.ndarray:
    """The share of signs and of tokens with digits in each text."""
    n = len(found.start)
    total = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(_DIGIT[raw], out=total[1:])
    odd = np.zeros(n + 1, np.int64)
    np.cumsum((found.end - found.start == 1) | (total[found.end] > total[found.start]), out=odd[1:])
    return (odd[found.first[1:]] - odd[found.first[:-1]]) / np.maximum(np.diff(found.first), 1)


def features(raw: np.ndarray, found: Tokens, surprise: np.ndarray = NO_SURPRISE, odd: np.ndarray | None = None) -> np.ndarray:
    """Slots of the weight table, a row per token: its shape, its beginning, its
    changes between letters, cases and digits, and how unlikely its letters
    follow each other; the shapes and words before and after; and how much of
    its text is made of signs and digits (``odd``, counted here if not given)."""
    start, end = found.start, found.end
    n = len(start)
    size = end - start

    def before(values: np.ndarray, dtype: type) -> np.ndarray:
        total = np.zeros(len(raw) + 1, dtype)
        np.cumsum(values, out=total[1:])
        return total

    def count(table: np.ndarray) -> np.ndarray:
        total = before(table[raw], np.int32)
        return total[end] - total[start]

    def inner(values: np.ndarray, dtype: type) -> np.ndarray:
        """Sums of values of neighbouring bytes within each token."""
        total = np.zeros(len(raw) + 1, dtype)
        np.cumsum(values, out=total[2:])
        return total[end] - total[np.minimum(start + 1, len(raw))]

    digits, uppers, lowers, symbols, hexes = map(count, (_DIGIT, _UPPER, _LOWER, _SYMBOL, _HEX))
    beyond = size > digits + uppers + lowers + symbols
    case, letter = _CASE[raw], _LETTER[raw]
    change = np.clip(inner(case[1:] != case[:-1], np.int32), 0, 7)
    rare = inner(surprise[letter[:-1], letter[1:]], np.float64) / np.maximum(size - 1, 1)
    rare = np.searchsorted(_SURPRISES, rare, side="right")
    length = np.searchsorted(_LENGTHS, size, side="right")
    lead = np.where(size == 1, raw[start], 0).astype(np.int64)
    shape = ((((length * 5 + np.minimum(4 * digits // np.maximum(size, 1), 4)) * 2 + (digits > 0)) * 2 + (uppers > 1)) * 2
             + (lowers > 0)) * 2 + (symbols > 0)
    shape = (shape * 2 + (hexes == size)) * 256 + np.where(size == 1, lead, 0)
    kinds = ((digits > 0) * 2 + (uppers > 0)) * 2 + (lowers > 0)
    coarse = (np.searchsorted([8, 12, 16, 24], size, side="right") * 8 + kinds) * 2 + beyond
    word = hash_words(raw, start, np.minimum(end, start + 16)).astype(np.int64) & 0xFFFFFFFF
    prefix = hash_words(raw, start, np.minimum(end, start + 4)).astype(np.int64) & 0xFFFFFFFF
    row = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))

    def shifted(values: np.ndarray, by: int) -> np.ndarray:
        """Values of the token ``by`` places on in the same text, or -1."""
        out = np.full(n, -1, np.int64)
        if by < 0:
            same = row[-by:] == row[:by] if n > -by else np.zeros(0, bool)
            out[-by:] = np.where(same, values[:by], -1) if n > -by else out[-by:]
        elif n > by:
            out[:-by] = np.where(row[by:] == row[:-by], values[by:], -1)
        return out

    share = odd_share(found, raw) if odd is None else odd
    file = np.searchsorted([0.02, 0.05, 0.1, 0.3], share)[row] if n else np.zeros(0, np.int64)
    last = shifted(word, -1)
    templates = (
        shape, length * 8 + change, prefix, shifted(shape, -1), shifted(shape, 1), last, shifted(word, -2),
        last * 64 + length, shifted(word, 1), file * 4096 + length * 16 + np.minimum(digits, 15),
        coarse * 16 + rare, (coarse * 16 + rare) * 8 + change, coarse * 8 + (change >= 3) * 2 + (symbols > 0),
    )
    out = np.empty((n, len(templates)), np.uint16)
    for k, value in enumerate(templates):
        out[:, k] = mix64(value.astype(np.int64).view(np.uint64) * np.uint64(16) + np.uint64(k)) & np.uint64(SLOTS - 1)
    return out


# --- the random field ----------------------------------------------------------


class Field(NamedTuple):
    """Weights of features (a row per slot, a column per tag), transitions, and
    the surprise of letter pairs that features are made with."""

    weights: np.ndarray
    moves: np.ndarray
    surprise: np.ndarray = NO_SURPRISE

    def emissions(self, slots: np.ndarray) -> np.ndarray:
        out = np.zeros((len(slots), 3), np.float32)
        for k in range(slots.shape[1]):
            out += self.weights[slots[:, k]]
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(slots: np.ndarray, tags: np.ndarray, mask: np.ndarray, epochs: int = EPOCHS) -> Field:
    """The field of greatest conditional likelihood, with a small penalty on
    weights, by gradient steps of adaptive size. Arrays are windows by places
    (by features); ``mask`` tells the places in use, from the left."""
    n, width, k = slots.shape
    weights, moves = np.zeros((SLOTS, 3)), np.zeros((3, 3))
    state = [np.zeros_like(x) for x in (weights, moves, weights, moves)]
    gold = np.eye(3)[tags] * mask[:, :, None]
    pairs = mask[:, 1:] & mask[:, :-1]
    gold_moves = np.einsum("ijk,ijl,ij->kl", gold[:, :-1], gold[:, 1:], pairs)
    flat = slots.reshape(-1, k)
    for epoch in range(1, epochs + 1):
        emit = sum(weights[flat[:, j]] for j in range(k)).reshape(n, width, 3)
        forward, backward = np.zeros((n, width, 3)), np.zeros((n, width, 3))
        forward[:, 0] = emit[:, 0]
        for t in range(1, width):
            step = _log_sum(forward[:, t - 1, :, None] + moves, 1) + emit[:, t]
            forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
        for t in range(width - 2, -1, -1):
            step = _log_sum(moves + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], step, 0)
        total = _log_sum(forward[:, -1], 1)
        chance = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
        both = np.exp(
            forward[:, :-1, :, None] + moves + (emit[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ) * pairs[:, :, None, None]
        error = (chance - gold).reshape(-1, 3)
        slope = np.zeros((SLOTS, 3))
        for j in range(k):
            for tag in range(3):
                slope[:, tag] += np.bincount(flat[:, j], error[:, tag], SLOTS)
        slopes = (slope / n + 2e-5 * weights, (both.sum(axis=(0, 1)) - gold_moves) / n + 2e-5 * moves)
        for x, g, m, v in zip((weights, moves), slopes, state[:2], state[2:], strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= 0.1 * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-6)
    return Field(weights.astype(np.float32), moves.astype(np.float32))


def decode(field: Field, emit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best tags of each text's tokens (Viterbi). A token whose outside score
    leads by more than any two transitions can make up is outside in every best
    path, and what stands before and after it is decoded by itself."""
    n = len(emit)
    tags = np.full(n, OUTSIDE, np.int8)
    if not n:
        return tags
    move = field.moves
    lead = np.array([
        max(move[i, k] + move[k, j] - move[i, OUTSIDE] - move[OUTSIDE, j] for i in range(3) for j in range(3))
        for k in (BEGIN, INSIDE)
    ])
    # at the ends of a text there is one transition only
    edge = np.array([
        max(max(move[i, k] - move[i, OUTSIDE], move[k, i] - move[OUTSIDE, i], 0.0) for i in range(3)) for k in (BEGIN, INSIDE)
    ])
    open_ = ((emit[:, OUTSIDE, None] - emit[:, :2]) <= np.maximum(lead, edge) + 1e-3).any(axis=1)
    # an open run is decoded with the certain tokens next to it, in its text
    head = np.zeros(n + 1, bool)
    head[first] = True
    use = open_.copy()
    use[1:] |= open_[:-1] & ~head[1:n]
    use[:-1] |= open_[1:] & ~head[1:n]
    where = np.flatnonzero(use)
    if not len(where):
        return tags
    new = np.r_[True, (np.diff(where) > 1) | head[where[1:]]]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(where)))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    best = emit[where[starts]].astype(np.float64)
    back: list[np.ndarray] = []
    for t in range(1, int(sizes[0])):
        live = int(np.searchsorted(-sizes, -t))  # runs longer than t
        paths = best[:live, :, None] + move
        back.append(paths.argmax(axis=1).astype(np.int8))
        best[:live] = paths.max(axis=1) + emit[where[starts[:live] + t]]
    tag = best.argmax(axis=1)
    for t in range(int(sizes[0]) - 1, -1, -1):
        live = int(np.searchsorted(-sizes, -t))
        tags[where[starts[:live] + t]] = tag[:live]
        if t:
            tag[:live] = back[t - 1][np.arange(live), tag[:live]]
    return tags


# --- fitting and scanning --------------------------------------------------------


class Example(NamedTuple):
    """A piece of a text, where secrets are in it, and its text's share of odd tokens."""

    text: str
    spans: list[tuple[int, int]]
    odd: float


def _random_value(rng: random.Random) -> str:
    """Something random, in one of the shapes that secrets come in."""
    lower, upper, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    signs = [
        digits + "abcdef", digits + "ABCDEF", digits + lower, digits + upper, digits + upper,
        digits + lower + upper, digits + lower + upper + "+/", digits + lower + upper + "_-",
    ]
    shape = rng.randrange(6)

    def run(low: int, high: int, of: str | None = None) -> str:
        of = of or rng.choice(signs)
        while True:  # digits and letters, as what has only one of them is found elsewhere too
            out = "".join(rng.choices(of, k=rng.randint(low, high)))
            if any(c.isdigit() for c in out) and any(c.isalpha() for c in out):
                return out

    if shape == 0:
        mark = "".join(rng.choices(rng.choice((lower, upper)), k=rng.randint(2, 5)))
        return mark + rng.choice(("_", "-", "", "_live_", "_test_", "-v1-")) + run(14, 44)
    if shape == 1:
        of = signs[7]
        return ".".join(run(14, 60, of) for _ in range(rng.randint(2, 3)))
    if shape == 2:
        of, size = rng.choice(signs[:5]), rng.randint(4, 8)
        return rng.choice("-_").join(run(size, size, of) for _ in range(rng.randint(4, 6)))
    return run(12 if shape == 3 else 16, 20 if shape == 3 else 48)


def _assigned(rng: random.Random, value: str) -> tuple[str, int]:
    """``value`` under a key, or alone, and where it begins."""
    key = rng.choice(KEYS) if rng.random() < 0.6 else "".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 9)))
    key = rng.choice((key, key.upper(), key.capitalize()))
    before, behind = rng.choice((
        (f"{key}=", ""), (f"{key}: ", ""), (f'{key} = "', '"'), (f"{key}='", "'"), (f'"{key}": "', '",'),
        (f"{key} ", ""), (f"{key}: Bearer ", ""), ("(", ")"), *[("", "")] * 5,
    ))
    return f"{before}{value}{behind}", len(before)


def _look_alike(rng: random.Random, words: list[str]) -> str:
    """Something with signs, digits or a key word that is no secret."""
    word = lambda: rng.choice(words)
    number = lambda low, high: "".join(rng.choices(string.digits, k=rng.randint(low, high)))
    day = f"{rng.randint(1980, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
    key = rng.choice(KEYS + ("password", "token", "secret"))
    return rng.choice((
        lambda: number(4, 19), lambda: number(9, 24), lambda: f"+{number(1, 2)} ({number(3, 3)}) {number(3, 3)}-{number(4, 4)}",
        lambda: ".".join(number(1, 3) for _ in range(4)), lambda: " ".join(number(4, 4) for _ in range(4)),
        lambda: day, lambda: f"{day}T{number(2, 2)}:{number(2, 2)}:{number(2, 2)}Z", lambda: f"v{number(1, 2)}.{number(1, 2)}.{number(1, 2)}",
        lambda: f"https://www.{word()}.org/{word()}/{word()}-{number(1, 6)}", lambda: f"{word()}.{word()}{number(1, 3)}@{word()}.com",
        lambda: f"https://{word()}.com/{word()}?id={number(3, 9)}&page={word()}", lambda: f"{word()}_{day}_{word()}.pdf",
        lambda: f"{word()}_{word()}_{word()}", lambda: word().capitalize() + word().capitalize() + word().capitalize(),
        lambda: "-".join(word() for _ in range(rng.randint(2, 5))), lambda: "/".join(word() for _ in range(rng.randint(2, 5))),
        lambda: f"{word()}{number(1, 4)}", lambda: f"{word()}-{number(1, 4)}", lambda: f"{number(1, 3)},{number(3, 3)}.{number(2, 2)}",
        lambda: f"{key}: {word()}", lambda: f"{key} = {word()}{word()}", lambda: f"{key} {word()} {word()}",
        lambda: f"{key}: {number(4, 12)}", lambda: (word() + word() + word()).upper(), lambda: word() + word() + word(),
        lambda: f"/usr/{word()}/{word()}/{word()}{number(1, 2)}.txt", lambda: f"978-{number(1, 1)}-{number(4, 4)}-{number(4, 4)}-{number(1, 1)}",
    ))()


def _put(rng: random.Random, own: Example, piece: str, span: tuple[int, int] | None) -> Example:
    """``piece`` put between two words of a text without a secret."""
    gaps = [m.start() for m in re.finditer(r"\s", own.text)] or [len(own.text)]
    at = rng.choice(gaps)
    spans = [(at + 1 + span[0], at + 1 + span[1])] if span else []
    return Example(f"{own.text[:at]} {piece} {own.text[at:]}", spans, own.odd)


def examples(secret: list[Example], clean: list[Example]) -> list[Example]:
    """What the tagger learns from, alike on every run: the texts as they are;
    those with a secret with another key word and another value; those without
    one with a made secret, and with look-alikes, put in."""
    rng = random.Random(0)
    out = []
    words = [w for own in clean for w in re.findall(r"[A-Za-z]{3,12}", own.text)] or ["the"]
    for own in secret:
        # a value that is an ordinary word is no model for others
        shown = [(s, e) for s, e in own.spans if any(c.isdigit() for c in own.text[s:e]) and e - s >= LEAST_CHARS]
        if shown:
            out.append(Example(own.text, shown, own.odd))
        if len(own.spans) == 1:
            piece, at = _assigned(rng, value := _random_value(rng))
            start, end = own.spans[0]
            whole = re.search(r"\S*\s?[:=]?\s?\S*$", own.text[:start]).start()
            text = f"{own.text[:whole]} {piece} {own.text[end:].lstrip(chr(34) + chr(39))}"
            out.append(Example(text, [(whole + 1 + at, whole + 1 + at + len(value))], own.odd))
    for own in clean:
        out.append(own)
        for _ in range(MADE):
            piece, at = _assigned(rng, value := _random_value(rng))
            out.append(_put(rng, own, piece, (at, at + len(value))))
        for _ in range(2):
            own = _put(rng, own, _look_alike(rng, words), None)
        out.append(own)
    return out


def _windows(found: list[Example], surprise: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(feature slots, tags) of each piece, about its secret or as a whole."""
    out = []
    for own in found:
        raw, at = text_buffer(pa.array([own.text]))
        tags_of = tokens(raw, at)
        slots = features(raw, tags_of, surprise, np.array([own.odd]))
        tags = np.full(len(slots), OUTSIDE)
        chars = chars_before(raw)
        low, high = chars[tags_of.start], chars[tags_of.end]
        centre = len(slots) // 2
        for start, end in own.spans:
            inside = np.flatnonzero((low < end) & (high > start))
            if len(inside):
                tags[inside] = INSIDE
                tags[inside[0]] = BEGIN
                centre = int(inside[0])
        first = max(0, min(centre - WIDTH // 2, len(slots) - WIDTH))
        if len(slots):
            out.append((slots[first : first + WIDTH], tags[first : first + WIDTH]))
    return out


def _sampler(kinds: tuple[str, ...], size: int):
    """Of the texts of a task with a secret, and of those without one, pieces of
    the ``size`` with the smallest hashes. Texts with secrets of other kinds than
    ``kinds`` are neither."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bool, list] = {True: [], False: []}  # heaps, largest hash first
        seen: dict[bool, set] = {True: set(), False: set()}

        def limit(secret: bool) -> int:
            return -kept[secret][0][0] if len(kept[secret]) == size else 2**63

        for batch in batches:
            raw, at = text_buffer(batch["text"])
            hashes = batch["h"].to_pylist()
            for low, high in slices(at):
                if all(h >= max(limit(True), limit(False)) for h in hashes[low:high]):
                    continue
                long_hex, maybe = _maybe(raw[at[low] : at[high]], at[low : high + 1] - at[low])
                for r in range(low, high):
                    h, shown = hashes[r], bool(maybe[r - low])
                    if h >= max(limit(shown), limit(False)) or at[r] == at[r + 1]:
                        continue
                    text = batch["text"][r].as_py()
                    base = base_spans(text, bool(long_hex[r - low])) if shown else []
                    secret = bool(base)
                    if h >= limit(secret) or h in seen[secret] or any(s[2] not in kinds for s in base):
                        continue
                    kept_row = (-h, *_piece(text, base, h))
                    seen[secret].add(h)
                    if len(kept[secret]) < size:
                        heapq.heappush(kept[secret], kept_row)
                    else:
                        seen[secret].discard(-heapq.heappushpop(kept[secret], kept_row)[0])
        rows = [(secret, -h, *row) for secret in (True, False) for h, *row in kept[secret]]
        if rows:
            columns = [list(c) for c in zip(*rows, strict=True)]
            kinds_of = (pa.bool_(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds_of, strict=True)], names=["secret", "h", "text", "places", "odd"])

    return run


def _piece(text: str, base: list, h: int) -> tuple[str, list[int], float]:
    """A piece about one secret, or about some place: (text, starts and ends of
    the secrets in it, share of odd tokens of the whole text)."""
    raw, at = text_buffer(pa.array([text]))
    odd = float(odd_share(tokens(raw, at), raw)[0])
    if not base:
        low = max(0, h % max(len(text), 1) - AROUND)
        return text[low : low + 2 * AROUND], [], odd
    one = base[h % len(base)]
    low, high = max(0, one[3] - AROUND), min(len(text), one[3] + 2 * AROUND)
    spans: list[list[int]] = []
    for start, end in sorted((s[3], s[1]) for s in base):
        start, end = max(start, low), min(end, high)
        if start < end and spans and start < spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        elif start < end:
            spans.append([start, end])
    return text[low:high], [p - low for s in spans for p in s], odd


def learn(documents: DataFrame, text: str = "text", kinds: tuple[str, ...] = KINDS[:3], size: int = SAMPLE_TEXTS) -> Field:
    """Fits the tagger on pieces of at most ``size`` distinct texts in which the
    patterns of ``kinds`` find something and as many in which no pattern does,
    those with the smallest hashes, and on copies of them that are changed as
    told at ``examples``. One pass over all texts; the driver gets pieces of at
    most ``3 * AROUND`` characters. Without any secret the tagger adds nothing."""
    share_code(documents.sparkSession)
    rows = documents.select(blank(F.col(f"`{text}`")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    drawn = rows.mapInArrow(_sampler(kinds, size), "secret boolean, h long, text string, places array<int>, odd double")
    pieces: dict[bool, list[Example]] = {True: [], False: []}
    best = drawn.dropDuplicates(["secret", "h"])
    # in parts first, so that what one task gets does not grow with the tasks before
    for by in (["secret", F.pmod("h", F.lit(PARTS))], ["secret"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("h"))
        best = best.withColumn("n", place).where(F.col("n") <= size)
    for r in best.orderBy("secret", "h").collect():
        places = r["places"]
        pieces[r["secret"]].append(Example(r["text"], list(zip(places[::2], places[1::2], strict=True)), r["odd"]))
    if not pieces[True]:
        return Field(np.zeros((SLOTS, 3), np.float32) + np.float32([0, 0, 1]), np.zeros((3, 3), np.float32))
    surprise = surprise_of([own.text for own in pieces[False] or pieces[True]])
    windows = _windows(examples(pieces[True], pieces[False]), surprise)
    width = max(len(s) for s, _ in windows)
    slots = np.zeros((len(windows), width, windows[0][0].shape[1]), np.int64)
    tags, mask = np.full((len(windows), width), OUTSIDE), np.zeros((len(windows), width), bool)
    for k, (s, t) in enumerate(windows):
        slots[k, : len(s)], tags[k, : len(t)], mask[k, : len(t)] = s, t, True
    return fit(slots, tags, mask)._replace(surprise=surprise)


def _maybe(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a long run of hex signs, and those in which any pattern may match."""
    # runs of hex signs, cut where a text begins
    hexes, heads = _HEX[raw], np.zeros(len(raw) + 1, bool)
    heads[at] = True
    starts = np.flatnonzero(hexes & (heads[:-1] | ~np.r_[False, hexes[:-1]]))
    stops = np.flatnonzero(hexes & (heads[1:] | ~np.r_[hexes[1:], False])) + 1
    long_hex = np.zeros(len(at) - 1, bool)
    long_hex[np.searchsorted(at, starts[stops - starts >= 24], side="right") - 1] = True
    signs = np.zeros(len(raw) + 1, np.int32)
    np.cumsum((raw == 58) | (raw == 61), out=signs[1:])
    maybe = long_hex | (signs[at[1:]] > signs[at[:-1]])
    keys = np.flatnonzero((raw[:-3] == 65) & (raw[1:-2] == 75) & (raw[2:-1] == 73) & (raw[3:] == 65)) if len(raw) > 3 else []
    maybe[np.searchsorted(at, keys, side="right") - 1] = True
    return long_hex, maybe


def _scan(sent, own: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            raw, at = text_buffer(batch[own])
            others = [c for c in batch.schema.names if c != own]
            for low, high in slices(at):
                part = batch.slice(low, high - low)
                texts = part[own]
                secrets = _spans(raw[at[low] : at[high]], at[low : high + 1] - at[low], texts, field)
                column = pa.array([[{"kind": k, "start": s, "end": e} for s, e, k in row] for row in secrets], pa.list_(kind))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in others), column], names=[*others, "secrets"])

    return run


def _spans(raw: np.ndarray, at: np.ndarray, texts: pa.Array, field: Field) -> list[list[tuple[int, int, str]]]:
    n = len(at) - 1
    long_hex, maybe = _maybe(raw, at)
    base: dict[int, list] = {int(r): base_spans(texts[int(r)].as_py() or "", bool(long_hex[r])) for r in np.flatnonzero(maybe)}
    found = tokens(raw, at)
    tags = decode(field, field.emissions(features(raw, found, field.surprise)), found.first)
    out = [[(s, e, k) for s, e, k, _ in base.get(r, ())] for r in range(n)]
    tagged = np.flatnonzero(tags != OUTSIDE)
    if len(tagged):
        row = np.searchsorted(found.first, tagged, side="right") - 1
        new = np.r_[True, (np.diff(tagged) > 1) | (row[1:] != row[:-1]) | (tags[tagged[1:]] == BEGIN)]
        chars = chars_before(raw)
        a = tagged[new]
        b = tagged[np.append(np.flatnonzero(new)[1:] - 1, len(tagged) - 1)]
        for r, s, e in zip(row[new].tolist(), chars[found.start[a]].tolist(), chars[found.end[b]].tolist(), strict=True):
            zero = int(chars[at[r]])
            s, e = s - zero, e - zero
            if e - s >= LEAST_CHARS and all(e <= x or s >= y for x, y, _, _ in base.get(r, ())):
                out[r].append((s, e, "crf"))
    return [sorted(row, key=lambda s: (s[0], KINDS.index(s[2]))) for row in out]


def find_secrets(documents: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``documents`` without the text, with ``secrets``: array of (kind, start,
    end) in code points, by start and then kind (assign, access, hex, crf).

    The fixed patterns' spans are always there; the tagger adds spans that
    touch none of them. Null and empty texts have none; repeated rows are
    treated alike; very long texts are read whole, in a step of their own;
    other columns are carried through whatever their names, one named secrets
    is replaced. Rows stay where they are; an empty table gives an empty table.
    """
    spark = documents.sparkSession
    share_code(spark)
    others = [c for c in documents.columns if c not in (text, "secrets")]
    own = "text"
    while own in others:
        own += "_"
    rows = documents.select(*[F.col(f"`{c}`") for c in others], blank(F.col(f"`{text}`")).alias(own))
    schema = ", ".join([*(f"`{n}` {t}" for n, t in rows.dtypes if n != own), f"secrets {_SPANS}"])
    return rows.mapInArrow(_scan(spark.sparkContext.broadcast(field), own), schema)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(documents, learn(documents))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"),
    )


SQL = None
