"""Secret scans: fixed patterns, and a randomness test battery for what they miss.

Base spans come from three patterns (an assignment to a secret's name, an
access key, a long hexadecimal run).  Every other candidate, a run of at least
``least`` characters of an encoding alphabet that is no mere number, is put to
three tests under the encoding inferred from its characters: chi-squared
uniformity over the alphabet, runs above and below the alphabet's middle, and
serial correlation of neighbours.  A random key passes all three; words,
numbers in sequence and padded or repeated strings fail at least one.  The
candidates that pass get a p-value for being words or a pattern, from the changes
of kind and from the letter pairs, which falls with length; Benjamini-Hochberg control within the text, weighted by length,
decides which are reported.

All work is row by row in the tasks, without any shuffle.

Cases: a null or empty text has no spans; very long texts are scanned whole;
spans never overlap within a kind; base spans are cut out of the candidates, what
is left of one is tested by itself; repeated rows give equal results; a table without rows
gives none; a column with the name of a result column is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import record_batch, sha256_hex, text_slices

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Encoding alphabets, narrowest first.
HEX_LOWER = "0123456789abcdef"
HEX_UPPER = "0123456789ABCDEF"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_LOWER = "abcdefghijklmnopqrstuvwxyz234567"
UPPER_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_DIGITS = "0123456789abcdefghijklmnopqrstuvwxyz"
LETTERS = UPPER + LOWER
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
BASE64_URL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
ENCODINGS = (HEX_LOWER, HEX_UPPER, LOWER, UPPER, BASE32, BASE32_LOWER, UPPER_DIGITS, LOWER_DIGITS, LETTERS, BASE62, BASE64,
             BASE64_URL)
_SETS = tuple(frozenset(a) for a in ENCODINGS)
_PLACES = tuple({c: k for k, c in enumerate(a)} for a in ENCODINGS)
# log2 of how much likelier than by chance a letter (column) follows
# another (row) in words, in halves from Q = 0; from the words of Python's own
# modules and the pieces of a public multilingual tokenizer.
LETTER_PAIRS = """
JQSQILPJQHNTRTFQFUSUONMLOJ
TNOMUJKKTPIUMLSNISRNTIHIPJ
TGOKTJHTRGRRLJVKIQNTQIHGMH
SMMPWMLIVKHPLMSLHQRNRLKJNG
RLRTPONJMHJRQULPLUTRKOMQLH
SJLMTTLIVHHRLLTLJSPQRIJIOH
RKLKWLPSTHHRNRRLHTRNRKIHLK
VLKLVKIIUHJNNNUIHQNRQHJHOH
QOSQROQGHIKRQVTOHPSSHPEMCO
UMONVMMMQMPMMNUOMMQMUMMMNM
RLNOWMOLUJLRKQQNKOTPPLPJNK
TKLPVLJHUFKTKLTMFIQQQMIFSH
VQJMWKIHTGJMQLTUFJPNQHHFMF
SJSTTOUJRINMJORLHISUOOHGLH
MOQRLNOJNGNRSVPREURQRPQKKH
UILMULJPRFJTJKTRIUPSQHJFOF
MMMNMMMMNMMOMPNNNPONXMMMMM
TKOPVLOITENNPPTMFQSRPMKFPH
QIRLULKRTGNONLRRJKSVRJLHOH
TIOLVLGSVFGOMKSMETRQPILHQI
QQQPROPGQGISSUMRFUTTIJGJII
VJKJXKKJUIIKMKRKIKKKKIKIJI
VKMOUMJRUJKOKSTLJSRNLKNLMJ
QNTNTPLOTKKPOKOUKMOVMMLOPL
POQPSOMMRKKRSSQUKPTSKMOKMM
TMMMXMMMTLLNONSMLNMOOLNMPP""".split()
PAIR_MEAN, PAIR_SPREAD = 0.4, 1.6  # of a pair in words: below the usual 1.1, for names, abbreviations and other languages
LEAST_PAIRS = 10
_LETTER_RUN = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[A-Z]+")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind order."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def infer_encoding(value: str) -> int | None:
    """The narrowest alphabet that has all characters of the value."""
    chars = set(value)
    return next((k for k, s in enumerate(_SETS) if chars <= s), None)


def _normal_tail(z: float) -> float:
    """Two-sided tail of the normal distribution."""
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_squared_tail(x: float, df: int) -> float:
    """Upper tail by the Wilson-Hilferty cube root."""
    if x <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return math.erfc(z / math.sqrt(2)) / 2


def randomness_tests(value: str, encoding: int) -> tuple[float, float, float]:
    """p-values of uniformity, runs and serial correlation: small if the value
    is not random text of the encoding."""
    places, size = _PLACES[encoding], len(ENCODINGS[encoding])
    x = np.fromiter((places[c] for c in value), dtype=np.float64, count=len(value))
    n = len(x)
    # Cells of the alphabet wide enough for five expected characters, if possible.
    cells = max(2, min(size, n // 5))
    counts = np.bincount((x * cells // size).astype(np.int64), minlength=cells)
    expected = np.bincount(np.arange(size) * cells // size, minlength=cells) * n / size
    uniform = _chi_squared_tail(float(((counts - expected) ** 2 / expected).sum()), cells - 1)
    above = x >= size / 2
    n1 = int(above.sum())
    n2 = n - n1
    if n1 and n2:
        runs = 1 + int((above[1:] != above[:-1]).sum())
        mean = 1 + 2 * n1 * n2 / n
        spread = 2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1))
        runs_p = _normal_tail((runs - mean) / math.sqrt(spread)) if spread > 0 else 0.0
    else:
        runs_p = 0.0
    d = x - x.mean()
    power = float((d * d).sum())
    serial = _normal_tail((float((d[1:] * d[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    return uniform, runs_p, serial


def _kind_shares(alphabet: str) -> list[float]:
    """Shares of digits, lower and upper case among the alphabet's letters and digits."""
    kinds = [0 if c.isdigit() else 1 if c.islower() else 2 for c in alphabet if c.isalnum()]
    return [kinds.count(k) / len(kinds) for k in range(3)]


#: Changes of kind from one character to the next: random text of each encoding.
_RANDOM_CHANGES = tuple(1 - sum(p * p for p in _kind_shares(a)) for a in ENCODINGS)


def _binomial_tail(k: int, n: int, p: float) -> float:
    """P(at least k of n)."""
    if k <= 0:
        return 1.0
    if n > 200:
        return math.erfc((k - 0.5 - n * p) / math.sqrt(2 * n * p * (1 - p))) / 2
    return min(1.0, sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k, n + 1)))


def changes_p(value: str, encoding: int) -> float:
    """p-value of the changes between lower case, upper case and digits: words,
    numbers and names have one in eight places at most where all three kinds are
    written, and in proportion fewer where the encoding has fewer.  Names in
    camel case change too: values without a digit are left to the letter pairs."""
    # Marks between words are no change of kind.
    kinds = [0 if c.isdigit() else 1 if c.islower() else 2 for c in value if c.isalnum()]
    if len(set(kinds)) < 2 or 0 not in kinds:
        return 1.0
    rate = _RANDOM_CHANGES[encoding] / _RANDOM_CHANGES[ENCODINGS.index(BASE62)] / 8
    return _binomial_tail(sum(a != b for a, b in zip(kinds, kinds[1:])), len(kinds) - 1, rate)


def pairs_p(value: str) -> float:
    """p-value of the letter pairs: small if they are far less likely in words
    than those of words are.  Too few pairs tell nothing (1.0)."""
    total, n = 0.0, 0
    for m in _LETTER_RUN.finditer(value):
        places = [ord(c) - 97 for c in m[0].lower()]
        total += sum(ord(LETTER_PAIRS[a][b]) - 81 for a, b in zip(places, places[1:])) / 2
        n += len(places) - 1
    if n < LEAST_PAIRS:
        return 1.0
    return math.erfc((PAIR_MEAN - total / n) * math.sqrt(n) / PAIR_SPREAD / math.sqrt(2)) / 2


def language_p(value: str, encoding: int) -> float:
    """p-value of the hypothesis that the value is words, a number or a pattern:
    small if its kinds of characters change or its letters follow each other as
    in no such text; twice the smaller of the two tests.  One of little variety
    for its length is a pattern (1.0)."""
    n, size = len(value), len(ENCODINGS[encoding])
    variety = len(set(value)) / (size * (1 - (1 - 1 / size) ** n))  # of what random text would have
    return 1.0 if variety < 0.65 else min(1.0, 2 * min(changes_p(value, encoding), pairs_p(value)))


def discoveries(p_values: list[float], lengths: list[int], rate: float, least: int) -> list[bool]:
    """Benjamini-Hochberg at ``rate``; a candidate counts with a weight that
    grows with its length (longer candidates have more power), the weights'
    mean being one."""
    m = len(p_values)
    if not m:
        return []
    weights = np.sqrt(np.array(lengths) / least)
    weights /= weights.mean()
    q = np.array(p_values) / weights
    order = np.argsort(q, kind="stable")
    passed = np.flatnonzero(q[order] <= rate * np.arange(1, m + 1) / m)
    out = np.zeros(m, dtype=bool)
    if len(passed):
        out[order[: passed[-1] + 1]] = True
    return out.tolist()


def merged(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The union of the spans as disjoint intervals."""
    out: list[tuple[int, int]] = []
    for a, b, _ in spans:
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _left_over(text: str, blocks: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The candidates without the blocks, in pieces."""
    at = 0  # both lists go by place: blocks that end before a candidate are behind
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(blocks) and blocks[at][1] <= start:
            at += 1
        k = at
        while k < len(blocks) and blocks[k][0] < end:
            if blocks[k][0] > start:
                yield start, blocks[k][0]
            start = max(start, blocks[k][1])
            k += 1
        if start < end:
            yield start, end


def random_spans(text: str, taken: list[tuple[int, int, str]], least: int = 20, rate: float = 0.01,
                 alpha: float = 0.001) -> list[tuple[int, int, str]]:
    """(start, end, ``random``) of the candidates that the battery reports."""
    found, p_values = [], []
    for start, end in _left_over(text, merged(taken)):
        value = text[start:end].rstrip("=")
        if len(value) < least or value.isdigit():
            continue
        encoding = infer_encoding(value)
        if encoding is None or min(randomness_tests(value, encoding)) < alpha / 3:
            continue
        found.append((start, end, "random"))
        p_values.append(language_p(value, encoding))
    keep = discoveries(p_values, [b - a for a, b, _ in found], rate, least)
    return [s for s, k in zip(found, keep, strict=True) if k]


def scan_text(text: str | None, **options) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans, of one text (code points, end exclusive)."""
    if not text:
        return [], []
    base = base_spans(text)
    more = random_spans(text, base, **options)
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]))) if more else base


def render(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


_DIGEST = [T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
           T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()),
           T.StructField("spans", T.StringType())]
_SPANS = [T.StructField("secrets", T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("value", T.StringType())])))]


def scan(docs: DataFrame, text: str = "text", digests: bool = False, keep_text: bool = True, **options) -> DataFrame:
    """The documents with ``secrets``: kind, place and value of every span.
    With ``digests`` the base counts, ``base_sha256`` and ``spans``."""
    made = _DIGEST if digests else _SPANS
    docs = docs.drop(*(f.name for f in made))
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    schema = T.StructType(kept + made)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text):
                rows = []
                for t in part.column(text).to_pylist():
                    base, spans = scan_text(t, **options)
                    if digests:
                        counts = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
                        rows.append((*counts, sha256_hex(render(base).encode()), render(spans)))
                    else:
                        rows.append(([{"kind": k, "start": a, "end": b, "value": t[a:b]} for a, b, k in spans],))
                yield record_batch(schema, [part.column(f.name) for f in kept] + [list(c) for c in zip(*rows, strict=True)])

    return docs.mapInArrow(run, schema)


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[{kind}]") -> str:
    """The text with every span replaced by its mark; overlapping spans count once."""
    out, at = [], 0
    for a, b, kind in spans:
        if b <= at:
            continue
        out += [text[at: max(a, at)], mark.format(kind=kind) if a >= at else ""]
        at = b
    return "".join([*out, text[at:]])
