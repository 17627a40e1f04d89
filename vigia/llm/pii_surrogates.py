"""PII: detected entities get keyed, type-consistent surrogates.

Entities (e-mail, telephone, card, IP address, social security number, IBAN,
person names) are found in the tasks by patterns and check digits.  The
distinct entities of the whole corpus, in normal form, get surrogates drawn
from a keyed hash (HMAC-SHA256): digits for digits, letters for letters, valid
check digits where the original had them, given names of the same gender and
names of the same script.  Rounds of joins then check for collisions: an entity
whose surrogate is another's, or is itself an entity of the corpus, draws
again, until all surrogates are distinct.  The same entity has the same
surrogate everywhere (coreference) in the writing of each occurrence: case,
spaces and marks stay.

Only documents that can hold an entity meet the surrogates, in one join by
the text's hash; all others pass where they are.

Cases: a null text stays null, an empty one empty; entities never overlap (the
leftmost wins, then the kind first listed); copies get equal surrogates; an
IBAN ends at its country's length or its last valid end, and what a check rejects
is searched again; name parts found in a text are replaced at their bare mentions
there too, initials and function words excepted; very long texts are scanned whole; a table without rows gives none; extra columns
and their names are kept.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint
from .common import record_batch, set_aside, text_slices
from .quality_rules import WORD_BINS

KINDS = ("email", "iban", "ip", "ssn", "card", "phone", "male", "female", "surname")

# Titles, and given names by gender and script.
MALE_TITLES = "Mr Herr Monsieur Señor Sr Mister".split()
FEMALE_TITLES = "Mrs Ms Miss Frau Madame Mme Señora Sra".split()
OTHER_TITLES = "Dr Prof".split()
MALE_NAMES = """James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony
Hans Klaus Jürgen Wolfgang Stefan Andreas Pierre Jean-Pierre François Jacques Laurent José Javier Carlos Miguel Antonio
Иван Дмитрий Сергей Александр Алексей Γιώργος Δημήτρης Νίκος""".split()
FEMALE_NAMES = """Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Margaret Emily Katharina Ursula
Sabine Monika Brigitte Françoise Monique Nathalie Isabelle Carmen Dolores Pilar Lucía María Ольга Наталья Елена Татьяна
Анна Ελένη Μαρία Κατερίνα""".split()


def plain_name(value: str) -> str:
    """A name in lower case, composed; Greek without the accents that capitals lose."""
    value = unicodedata.normalize("NFC", value.lower())
    if any("Ͱ" <= c <= "Ͽ" for c in value):
        value = unicodedata.normalize("NFC", unicodedata.normalize("NFD", value).replace("\u0301", ""))
    return value


def _writings(names: list[str]) -> list[str]:
    """The names as listed and in capitals, composed and decomposed, longest first."""
    capitals = [n.upper() for n in names]
    every = {*names, *capitals, *(plain_name(n).upper() for n in names)}
    return sorted(every | {unicodedata.normalize("NFD", n) for n in every}, key=lambda n: (-len(n), n))


_GENDER = {plain_name(n): "male" for n in MALE_NAMES} | {plain_name(n): "female" for n in FEMALE_NAMES}
# Letters of surrogates by script: (vowels, consonants, endings of male, female and surnames).
SCRIPTS = {
    "latin": ("aeiou", "bdfgklmnprstv", ("on", "er", "in"), ("a", "ia", "elle"), ("son", "mann", "ez", "ard")),
    "cyrillic": ("аеиоу", "бвгдзклмнпрст", ("ей", "ан", "ир"), ("а", "ия", "ина"), ("ов", "ин", "ский")),
    "armenian": ("աեիոէ", "բգդզկլմնպստր", ("են", "ան", "իկ"), ("ա", "ինե", "ուհի"), ("յան", "ունի", "ենց")),
    "greek": ("αεηιο", "βγδζθκλμνπρστ", ("ος", "ης", "ας"), ("α", "η", "ινα"), ("ακης", "ιδης", "ου")),
}
DEFAULT_KEY = b"replace this key in production"
WIDER = 8  # attempts within the same space

# Lengths of IBANs by country.
IBAN_LENGTHS = {c: int(n) for c, n in (x.split(":") for x in """AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BR:29
BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DK:18 DO:28 EE:20 EG:29 ES:24 FI:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28
HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22
MK:19 MR:27 MT:31 MU:30 NL:18 NO:15 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 SA:24 SC:31 SD:18 SE:24 SI:19 SK:24 SM:27
ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 VA:22 VG:24 XK:20""".split())}


def _capitals() -> str:
    """The inside of a character class: every upper-case and title-case letter."""
    codes = [k for k in range(0x1F000) if unicodedata.category(chr(k)) in ("Lu", "Lt")]
    starts = [k for j, k in enumerate(codes) if not j or codes[j - 1] != k - 1]
    ends = [k for j, k in enumerate(codes) if j + 1 == len(codes) or codes[j + 1] != k + 1]
    return "".join(f"{chr(a)}-{chr(b)}" if a < b else chr(a) for a, b in zip(starts, ends, strict=True))


_FEMALE, _MALE = {plain_name(t) for t in FEMALE_TITLES}, {plain_name(t) for t in MALE_TITLES}
_UPPER = _capitals()
_PART = rf"[{_UPPER}][\w\u0300-\u036f'’]*"
_CAPITAL = rf"{_PART}(?:-{_PART})*"
# MS in capitals is a title before a name in capitals only.
_TITLES = "|".join(t for t in _writings(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES) if t != "MS")
_NAMES = "|".join(map(re.escape, _writings(MALE_NAMES + FEMALE_NAMES)))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_PATTERN = re.compile(
    # A run of address characters is tried once, from its start: linear on runs without an at sign.
    rf"(?<![A-Za-z0-9._%+-])[._%+-]*+(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{{2,}})"
    r"|(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?)(?![A-Za-z0-9])"
    rf"|(?<![\d.])(?P<ip>{_OCTET}(?:\.{_OCTET}){{3}})(?!\d|\.\d)"
    r"|(?<![\d-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d-])"
    r"|(?<![\d.-])(?P<card>\d{4}(?:[\x20-]\d{4}){3}|\d{13,19})(?![\d-])"
    r"|(?<![\w.])(?P<phone>\+\d{1,3}[\x20.-]?\(?\d{1,4}\)?(?:[\x20.-]?\d{2,4}){2,4}"
    r"|\(\d{2,4}\)[\x20.-]?\d{3,4}[\x20.-]\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w])"
    rf"|(?<!\w)(?=[{_UPPER}])(?P<title>{_TITLES}|MS(?=\.?\x20[{_UPPER}]{{2}}))\.?\x20(?P<titled>{_CAPITAL}(?:\x20{_CAPITAL})?)"
    rf"|(?<!\w)(?=[{_UPPER}])(?P<given>{_NAMES})\x20(?P<family>{_CAPITAL})")
#: What every text with an entity has: a filter for Spark, no more.
HINT = rf"[0-9@]|(?<!\p{{L}})(?=\p{{Lu}})(?:(?:{_TITLES}|MS)\.?|{_NAMES}) [\p{{Lu}}\p{{Lt}}]"
_MENTION = re.compile(rf"(?<!\w)(?=[{_UPPER}]){_CAPITAL}")
_POSSESSIVE = re.compile(r"(?:['’][sS]?)+\Z")


def luhn(digits: str) -> int:
    """Luhn sum modulo 10; 0 for a valid number."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10


def iban_rest(value: str) -> int:
    """Remainder modulo 97; 1 for a valid number."""
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def iban_end(m: re.Match) -> int | None:
    """Where the IBAN at the start of an IBAN-like match ends: at its country's
    length if that is valid, else at the longest valid end."""
    text, start, ends = m.string, m.start(), []
    size = 0
    for at in range(start, m.end()):
        if text[at] != " ":
            size += 1
            after = text[at + 1: at + 2]
            if size >= 12 and not (after.isascii() and after.isalnum()):
                ends.append((size == IBAN_LENGTHS.get(text[start: start + 2]), at + 1))
    return next((end for _, end in sorted(ends, reverse=True) if iban_rest(text[start:end].replace(" ", "")) == 1), None)


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities in order.  Names are split into given
    names and surnames, so that each is replaced alike wherever it stands; their
    bare mentions in the same text are found too.  What a check rejects is
    searched for other entities."""
    out, at = [], 0
    while m := _PATTERN.search(text, at):
        kind, end = m.lastgroup, m.end()
        if kind in ("titled", "family"):
            out += _names(m)
        elif kind == "iban":
            end = iban_end(m)
        elif kind == "phone" and not 7 <= sum(c.isdigit() for c in m[0]) <= 15:
            end = None
        if end is not None and kind not in ("titled", "family"):
            out.append((m.start(kind), end, kind))
        at = m.start() + 1 if end is None else end
    return _with_mentions(text, out)


def _with_mentions(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Adds the bare mentions of the names' parts, before and after the names.
    Initials and function words (``De``, ``La``) are no mentions."""
    parts: dict[str, str] = {}
    for a, b, kind in found:
        if kind in ("male", "female", "surname") and b - a > 1:
            parts.setdefault(plain_name(text[a:b]), kind)
    for word in WORD_BINS:
        parts.pop(word, None)
    if not parts:
        return found
    out, at = [], 0
    for span in [*found, (len(text), len(text), "")]:
        for m in _MENTION.finditer(text, at, span[0]):
            whole = _POSSESSIVE.sub("", m[0])
            if plain_name(whole) in parts:
                out.append((m.start(), m.start() + len(whole), parts[plain_name(whole)]))
                continue
            start = m.start()
            for piece in whole.split("-"):
                bare = _POSSESSIVE.sub("", piece)
                if plain_name(bare) in parts:
                    out.append((start, start + len(bare), parts[plain_name(bare)]))
                start += len(piece) + 1
        if span[2]:
            out.append(span)
        at = span[1]
    return out


def _names(m: re.Match) -> list[tuple[int, int, str]]:
    if m["given"]:
        return [(*m.span("given"), _GENDER[plain_name(m["given"])]), _named(m.start("family"), m["family"], "surname")]
    start, words = m.start("titled"), m["titled"].split(" ")
    if len(words) == 1:
        return [_named(start, words[0], "surname")]
    first, title = words[0], plain_name(m["title"])
    kind = _GENDER.get(plain_name(first)) or ("female" if title in _FEMALE else "male" if title in _MALE else "surname")
    return [_named(start, first, kind), _named(start + len(first) + 1, words[1], "surname")]


def _named(start: int, word: str, kind: str) -> tuple[int, int, str]:
    """The span of a name without its possessive ending."""
    return start, start + len(_POSSESSIVE.sub("", word)), kind


def normal(kind: str, value: str) -> str:
    """The form in which occurrences are compared: digits or letters only where
    marks are mere writing, lower case."""
    if kind in ("ssn", "card", "phone"):
        return "".join(c for c in value if c.isdigit() or c == "+")
    if kind == "iban":
        return value.replace(" ", "")
    return plain_name(value) if kind in ("male", "female", "surname") else value.lower()


# -- surrogates ---------------------------------------------------------------

class _Draw:
    """Numbers from a keyed hash of an entity and the attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed, self.count = hmac.new(key, f"{kind}\0{attempt}\0{value}".encode(), hashlib.sha256).digest(), 0

    def below(self, n: int) -> int:
        self.count += 1
        block = hashlib.sha256(self.seed + self.count.to_bytes(4, "big")).digest()
        return int.from_bytes(block[:8], "big") % n

    def pick(self, items):
        return items[self.below(len(items))]


def script_of(value: str) -> str:
    c = next((c for c in value if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "armenian" if "Ա" <= c <= "և" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def surrogate(kind: str, value: str, attempt: int = 0, key: bytes = DEFAULT_KEY) -> str:
    """The surrogate, in normal form, of an entity in normal form.

    A type's first ``WIDER`` attempts keep its shape; later ones draw from a
    wider space (longer local parts and numbers, other private and reserved
    addresses), so that a corpus that fills the first still ends."""
    d = _Draw(key, kind, value, attempt)
    wider = attempt // WIDER

    def same_shape(s: str) -> str:
        return "".join(str(d.below(10)) if c.isdigit() else d.pick("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in s)

    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{same_shape(local + 'a' * wider)}@{same_shape(host)}.{top}"
    if kind == "ip":
        parts = value.split(".")
        private = 1 if parts[0] == "10" else 2 if parts[:2] == ["192", "168"] else 0
        fresh = [str(1 + d.below(254)) for _ in parts]
        if wider >= 2:  # never routed
            return ".".join([str(240 + d.below(15)), *fresh[1:]])
        if wider and private:
            return ".".join(d.pick((["10", *fresh[1:]], ["172", str(16 + d.below(16)), *fresh[2:]], ["192", "168", *fresh[2:]])))
        if not private:
            fresh[0] = d.pick([str(x) for x in range(11, 224) if x not in (127, 169, 172, 192)])
        return ".".join(parts[:private] + fresh[private:])
    if kind == "card":
        body = value[0] + "".join(str(d.below(10)) for _ in value[1:-1])
        check = (10 - luhn(body + "0")) % 10
        return body + str(check if luhn(value) == 0 else (check + 1 + d.below(9)) % 10)
    if kind == "phone":
        keep = 2 if value.startswith("+") else 0  # the plus and the country's first digit
        return value[:keep] + "".join(str(d.below(10)) for _ in value[keep:] + "0" * wider)
    if kind == "ssn":
        return str(900 + d.below(100)) + f"{1 + d.below(99):02d}" + f"{1 + d.below(9999):04d}" + "".join(
            str(d.below(10)) for _ in range(wider))  # never issued
    if kind == "iban":
        body = "".join(str(d.below(10)) if c.isdigit() and not wider else d.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in value[4:])
        return f"{value[:2]}{98 - iban_rest(value[:2] + '00' + body):02d}{body}"
    vowels, consonants, *endings = SCRIPTS[script_of(value)]
    stem = "".join(d.pick(consonants) + d.pick(vowels) for _ in range(2 + d.below(2) + wider)) + d.pick(consonants)
    return stem + d.pick(endings[("male", "female", "surname").index(kind)])


def written_like(original: str, kind: str, fresh: str) -> str:
    """The surrogate in the writing of an occurrence: marks, spaces and case."""
    if kind in ("ssn", "card", "phone", "iban"):
        chars = iter(fresh)
        return "".join([next(chars) if c.isalnum() or c == "+" else c for c in original] + [*chars])
    if kind in ("male", "female", "surname"):
        return fresh.upper() if len(original) > 1 and original.isupper() else fresh[:1].upper() + fresh[1:]
    return "".join(f.upper() if c.isupper() else f for c, f in zip(original, fresh, strict=True)) if len(fresh) == len(original) else fresh


def rewrite(text: str, fresh: dict[tuple[str, str], str]) -> str:
    out, at = [], 0
    for a, b, kind in find_entities(text):
        out += [text[at:a], written_like(text[a:b], kind, fresh[kind, normal(kind, text[a:b])])]
        at = b
    return "".join([*out, text[at:]])


# -- Spark --------------------------------------------------------------------

_ENTITY = T.StructType([T.StructField("text_key", T.StringType()), T.StructField("kind", T.StringType()),
                        T.StructField("value", T.StringType())])


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(text_key, kind, value): the entities of every distinct text once, in
    normal form; the key is the SHA-256 of the text."""
    hinted = docs.select(F.col(text).alias("text")).filter(F.col("text").rlike(HINT))

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = []
                for t in part.column("text").to_pylist():
                    found = {(k, normal(k, t[a:b])) for a, b, k in find_entities(t)}
                    if found:
                        key = hashlib.sha256(t.encode()).hexdigest()
                        rows += [(key, *f) for f in sorted(found)]
                yield record_batch(_ENTITY, [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 3)

    return hinted.mapInArrow(run, _ENTITY).distinct()


def assign(values: DataFrame, key: bytes = DEFAULT_KEY, most_rounds: int = 64, draw=surrogate) -> DataFrame:
    """(kind, value, fresh): distinct surrogates of the distinct (kind, value).

    Each round the waiting entities draw; of those that drew the same one wins,
    and nobody gets what an entity of the corpus or an earlier winner is."""
    schema = T.StructType([*_ENTITY.fields[1:], T.StructField("fresh", T.StringType())])

    def drawing(attempt):
        def run(batches):
            for batch in batches:
                kinds, found = (batch.column(c).to_pylist() for c in ("kind", "value"))
                yield record_batch(schema, [kinds, found, [draw(k, v, attempt, key) for k, v in zip(kinds, found, strict=True)]])
        return run

    everyone = reliable_checkpoint(values.select("kind", "value").distinct(), "pii-entities")
    waiting, done = everyone, None
    for attempt in range(most_rounds):
        drawn = waiting.mapInArrow(drawing(attempt), schema)
        taken = everyone.select("kind", F.col("value").alias("fresh"))
        if done is not None:
            taken = taken.unionByName(done.select("kind", "fresh"))
        free = drawn.join(taken, ["kind", "fresh"], "left_anti")
        won = reliable_checkpoint(free.groupBy("kind", "fresh").agg(F.min("value").alias("value"))
                                  .select("kind", "value", "fresh"), "pii-won")
        done = won if done is None else done.unionByName(won)
        waiting = reliable_checkpoint(waiting.join(won, ["kind", "value"], "left_anti"), "pii-waiting")
        if not waiting.take(1):
            return done
    raise RuntimeError(f"surrogates still collide after {most_rounds} rounds")


def replace_entities(docs: DataFrame, key: bytes = DEFAULT_KEY, text: str = "text") -> DataFrame:
    """The documents, all columns, with surrogates for the entities of the texts."""
    docs, names = set_aside(docs, {"_fresh", "_key"}, (text,))
    found = reliable_checkpoint(entities(docs, text), "pii-found")
    fresh = assign(found, key)
    by_text = (found.join(fresh, ["kind", "value"]).groupBy("text_key")
               .agg(F.collect_list(F.struct("kind", "value", "fresh")).alias("_fresh")))
    hinted = F.coalesce(F.col(text).rlike(HINT), F.lit(False))
    touched = docs.filter(hinted).withColumn("_key", F.sha2(F.col(text).cast("binary"), 256)).join(
        by_text.withColumnRenamed("text_key", "_key"), "_key", "left").select(*[f"`{c}`" for c in docs.columns], "_fresh")
    schema = docs.schema

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, text):
                texts = [t if not f else rewrite(t, {(x["kind"], x["value"]): x["fresh"] for x in f}) for t, f in
                         zip(part.column(text).to_pylist(), part.column("_fresh").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, part.column(c).type) if c == text else part.column(c) for c in schema.names],
                    names=schema.names)

    return docs.filter(~hinted).unionByName(touched.mapInArrow(run, schema)).withColumnsRenamed(names)


def count_entities(text: str | None) -> int:
    return len(find_entities(text)) if text else 0
