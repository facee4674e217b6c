"""Personal data: fixed patterns, and a linear-chain conditional random field that adds what patterns miss.

Base spans come from one pattern per kind. The field works on white-space words with features of their shapes and their
neighbours' shapes; it is trained by exact likelihood on a small labelled table of lines and decoded by Viterbi in numpy over
batches of word sequences. Its spans are checked (digit counts, the card checksum) and never touch or replace base spans.

A sequence is a stretch of words around words with a digit or ``@``, two more words on either side within the line. Words far
from any digit and ``@`` are no candidates of these four kinds.

Positions are code points, end exclusive. Defined cases: null and empty texts have no spans; repeated rows and null ids are
scored like others; very long texts are scanned in linear time; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# The patterns of the four kinds. Look-behinds only keep a failed number from being tried at each of its digits.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DATA = re.compile(r"[0-9@]")
_WORD = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from each ``@`` outwards so long runs of word characters are read once."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            found.append(("email", begin, match.end()))
            free = match.end()
        at = text.find("@", match.end() if match else at + 1)
    return found


def base_spans(text: str) -> list[Span]:
    """Spans by pattern, by kind and then start; matches that fail their check are dropped."""
    found = _emails(text)
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return found


# The labelled table: invented lines whose marked parts are personal data of a kind.
LABELLED = (
    "call me on [phone:(212) 555-0147] after six", "his number is [phone:212-555-0188] at home", "tel [phone:020 7946 0991] ask for Ann",
    "phone [phone:(415) 555-0126]", "office: [phone:303.555.0119] or write", "you can ring [phone:555-013-5309] any time",
    "the and [phone:(614) 555-0135] of that", "ou est [phone:(508) 555-0164] dans la rue", "und [phone:030-555-0134] ist neu", "[phone:(871) 555-0199] von hier",
    "por [phone:915-555-0173] de la casa", "reach [phone:+1 (339) 555-0128] today", "on [phone:+44 20 7946 0123] now", "[phone:+33-1-5555-0132]",
    "either [phone:(503) 555-0141] [phone:614-555-0177] works", "[phone:206-555-0113] [phone:(206) 555-0114] and so on", "try [phone:(929) 555-0156] [phone:(929) 555-0157] now",
    "numbers [phone:702-555-0103] [phone:702-555-0104] [phone:702-555-0105] [phone:702-555-0106] in order", "all of [phone:503.555.0161] [phone:503.555.0162] [phone:503.555.0163]",
    "write to [email:ann.lee@example.org] soon", "from [email:bob@mail.example.com] to us", "mail [email:jo_34@site.example] please",
    "the of [email:kim@example.com] said", "contact [email:lee@example.net] first", "de [email:x.y+z@dom.example.co] para ti",
    "to [email:amy@example.org] [email:roy@example.org] both",
    "pay with [card:4111 1111 1111 1111] today", "card [card:5500-0000-0000-0004] expired", "number [card:4111111111111111] on file",
    "amex [card:3782 822463 10005] was used", "carte [card:4012.8888.8888.1881] de la", "visa [card:4222222222222] old",
    "host [ip:10.0.0.1] is up", "from [ip:192.168.17.254] came", "server [ip:203.0.113.77] und", "ping [ip:172.16.4.9] de la", "see [ip:8.8.8.8] there",
    "port at [ip:198.51.100.7:8080] open", "ip [ip:10.1.2.3/24] net", "from [ip:192.0.2.14] [ip:192.0.2.15] both",
    "on 2024-01-05 we met", "in 1999 and 2004 it was", "about 12,000.50 dollars", "at 10:30 or 11:45", "version 1.2.3 of it", "chapter 12.4 says", "it costs 45 euros",
    "order 4532 0001 of", "id 6203948571120395 and", "order 0512994830017722 shipped", "ref 1234567890 is", "token 7c1fe0aa90b3d45512ce88f0ab here",
    "call at 5 pm", "sections 3.1.4 to 3.1.5", "12 34 56 78", "a score of 3-2", "pages 10-12", "in 20 of 30 cases", "the 1st and 2nd", "item 1. and 2.", "100% of",
    "room 555", "isbn 978-3-16-148410-0 book", "@user wrote that", "at @ 3 pm", "size 10x20 and 5.5", "the and of that was with", "und der die das ist ein",
    "de la que el en los", "et les des une dans par", "so I said, no. Well", "price: 99.95 each", "http://example.com/a1 page", "9.99.9 or 1.", "615840927", "8.",
)
_MARK = re.compile(r"\[(email|ip|card|phone):([^\]]*)\]")
# Outside, the first word of a span by kind, and further words by kind: spans of a kind that touch stay apart.
_TAGS = ("O", *KINDS, *[f"{k}+" for k in KINDS])
AROUND = 2
BATCH = 2048
# Words of a decoding batch with all its sequences padded to the longest.
CELLS = 1 << 19
SLICE = 512
PLAIN = "word"


def shape(word: str) -> str:
    """Digits as 9 with their count kept, letters and other signs as runs; words without data are all alike."""
    if not _DATA.search(word):
        return PLAIN
    out = re.sub(r"[^\W\d_]+", "a", word.strip(".,;:!?\"'*%$#&|"))
    return re.sub(r"[0-9]{5,}", lambda m: f"9{{{min(len(m[0]), 20)}}}", out) if len(out) > 30 else re.sub(r"[0-9]", "9", out)


def kind_of(word: str) -> str:
    """A coarse class of a word, as a neighbour sees it."""
    if not _DATA.search(word):
        return PLAIN
    if "@" in word:
        return "at"
    bare = word.strip(".,;:!?\"'*%$#&|")
    return f"d{min(len(bare), 8)}" if bare.isdigit() else "par" if bare[:1] == "(" else "mix"


def features(words: list[str]) -> list[list[str]]:
    kinds = [kind_of(w) for w in words]
    before, after = ["edge", *kinds[:-1]], [*kinds[1:], "edge"]
    return [[f"s={shape(w)}", f"k={k}", f"p={p}", f"n={n}", f"kp={k},{p}", f"kn={k},{n}"] for w, k, p, n in zip(words, kinds, before, after, strict=True)]


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """The field's sequences: words with a digit or ``@`` and ``AROUND`` words on either side within the line, merged."""
    begin = 0
    while True:
        end = text.find("\n", begin)
        end = len(text) if end < 0 else end
        if _DATA.search(text, begin, end):
            words = [m.span() for m in _WORD.finditer(text, begin, end)]
            near: list[int] = []
            for i, (a, b) in enumerate(words):
                if _DATA.search(text, a, b):
                    low = max(0, i - AROUND)
                    if near and low > near[-1] + 1:
                        yield [words[j] for j in near]
                        near = []
                    near += range(max(low, near[-1] + 1 if near else 0), min(len(words), i + AROUND + 1))
            if near:
                yield [words[j] for j in near]
        if end == len(text):
            return
        begin = end + 1


def _table() -> list[tuple[list[str], list[int]]]:
    """The labelled lines as words and tags."""
    out = []
    for line in LABELLED:
        text, marks, at = "", [], 0
        for m in _MARK.finditer(line):
            text += line[at : m.start()]
            marks.append((len(text), len(text) + len(m[2]), KINDS.index(m[1]) + 1))
            text, at = text + m[2], m.end()
        text += line[at:]
        for words in stretches(text):
            tags = [next((tag if a == x or not i else tag + len(KINDS) for x, y, tag in marks if x <= a < y), 0) for i, (a, _) in enumerate(words)]
            out.append(([text[a:b] for a, b in words], tags))
    return out


class Tagger:
    """Feature weights (features x tags), transitions (tags x tags) and the scores of a first tag."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray, first: np.ndarray):
        self.names, self.weights, self.moves, self.first = names, weights, moves, first

    def scores(self, words: list[str]) -> np.ndarray:
        return np.array([self.weights[[self.names[f] for f in found if f in self.names]].sum(axis=0) for found in features(words)])

    def decode(self, sequences: list[np.ndarray]) -> list[list[int]]:
        """Viterbi over a batch: the best tags of each sequence of scores."""
        if not sequences:
            return []
        lengths = [len(s) for s in sequences]
        padded = np.zeros((len(sequences), max(lengths), len(_TAGS)))
        for i, s in enumerate(sequences):
            padded[i, : len(s)] = s
        best = padded[:, 0] + self.first
        back = np.zeros(padded.shape, np.int8)
        ends = best.copy()
        for t in range(1, padded.shape[1]):
            ways = best[:, :, None] + self.moves[None]
            back[:, t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + padded[:, t]
            now = np.array(lengths) == t + 1
            ends[now] = best[now]
        out = []
        for i, n in enumerate(lengths):
            tags = [int(ends[i].argmax())]
            for t in range(n - 1, 0, -1):
                tags.append(int(back[i, t, tags[-1]]))
            out.append(tags[::-1])
        return out


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _expected(scores: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward: the probability of each tag at each word, and the expected number of each transition."""
    n = len(scores)
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[0] = scores[0] + first
    for t in range(1, n):
        ahead[t] = _logsumexp(ahead[t - 1][:, None] + moves, 0) + scores[t]
    for t in range(n - 2, -1, -1):
        behind[t] = _logsumexp(moves + (scores[t + 1] + behind[t + 1])[None], 1)
    total = _logsumexp(ahead[-1], 0)
    pairs = np.zeros_like(moves)
    for t in range(1, n):
        pairs += np.exp(ahead[t - 1][:, None] + moves + (scores[t] + behind[t])[None] - total)
    return np.exp(ahead + behind - total), pairs


@lru_cache(maxsize=1)
def tagger(steps: int = 120, rate: float = 0.3, decay: float = 0.02) -> Tagger:
    """Trained on the labelled table by gradient ascent (AdaGrad) on the exact log-likelihood with an L2 prior."""
    table = [(features(words), tags) for words, tags in _table()]
    names = {f: i for i, f in enumerate(sorted({f for rows, _ in table for found in rows for f in found}))}
    data = [(np.array([[names[f] for f in found] for found in rows]), np.array(tags)) for rows, tags in table]
    k = len(_TAGS)
    params = [np.zeros((len(names), k)), np.zeros((k, k)), np.zeros(k)]
    seen = [np.full_like(p, 1e-8) for p in params]
    one = np.eye(k)
    for _ in range(steps):
        weights, moves, first = params
        grads = [-decay * p for p in params]
        for at, tags in data:
            marginal, pairs = _expected(weights[at].sum(axis=1), moves, first)
            np.add.at(grads[0], at, (one[tags] - marginal)[:, None, :])
            np.add.at(grads[1], (tags[:-1], tags[1:]), 1.0)
            grads[1] -= pairs
            grads[2] += one[tags[0]] - marginal[0]
        for p, g, s in zip(params, grads, seen, strict=True):
            s += g * g
            p += rate * g / np.sqrt(s)
    return Tagger(names, *params)


def _plausible(kind: str, found: str) -> bool:
    digits = re.sub("[^0-9]", "", found)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "ip":
        return len(re.findall("[0-9]+", found)) >= 4
    return "@" in found[1:-1]


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while a < b and not text[b - 1].isalnum():
        b -= 1
    return a, b


def _together(places: list[tuple[int, list]]) -> Iterator[list[tuple[int, list]]]:
    """Sequences sorted by length, as batches of bounded padded size; a sequence beyond it is alone."""
    begin = 0
    for end, (_, words) in enumerate(places):
        if end > begin and (end - begin == BATCH or (end - begin + 1) * len(words) > CELLS):
            yield places[begin:end]
            begin = end
    if places:
        yield places[begin:]


def find_spans(texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Per text its base spans and all spans, each by kind and then start."""
    base = [base_spans(t) for t in texts]
    model = tagger()
    places = [(i, words) for i, t in enumerate(texts) if _DATA.search(t) for words in stretches(t)]
    added: list[list[Span]] = [[] for _ in texts]
    # Sequences of like length are decoded together, a bounded number at a time.
    places.sort(key=lambda x: len(x[1]))
    for part in _together(places):
        tags = model.decode([model.scores([texts[i][a:b] for a, b in words]) for i, words in part])
        for (i, words), found in zip(part, tags, strict=True):
            t = 0
            while t < len(found):
                end = t + 1
                more = found[t] if found[t] > len(KINDS) or not found[t] else found[t] + len(KINDS)
                while end < len(found) and found[end] == more:
                    end += 1
                if found[t]:
                    a, b = _trimmed(texts[i], words[t][0], words[end - 1][1])
                    kind = KINDS[(found[t] - 1) % len(KINDS)]
                    if all(b <= x or a >= y for _, x, y in base[i]) and _plausible(kind, texts[i][a:b]):
                        added[i].append((kind, a, b))
                t = end
    return [(own, sorted([*own, *more], key=lambda s: (KINDS.index(s[0]), s[1]))) for own, more in zip(base, added, strict=True)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SPANS = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
    names = [part.split()[0] for part in SPANS.split(", ")]
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part, out = batch.slice(at, SLICE), []
            for doc, (base, whole) in zip(part.column(0).to_pylist(), find_spans(part.column(1).to_pylist()), strict=True):
                count = Counter(k for k, _, _ in base)
                out.append((doc, *(count[k] for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(whole), len(whole) - len(base)))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base spans per kind, the digest of the base spans, all spans as text, and how many were added."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_found, SPANS)


def masked(text: str) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans give way to the one that begins first."""
    out, at = [], 0
    for kind, a, b in sorted(find_spans([text])[0][1], key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
            at = b
    return "".join([*out, text[at:]])
