"""PII surrogates: planted entities, distinctness, coreference, formats, collisions."""

import random
import re

import pytest

from vigia.llm import pii_surrogates as p
from vigia.llm.queries import op2_pii_surrogates

MID = "/root/testdata/sf0.01"


def test_given_documents(spark):
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    after = {r["doc_id"]: r["text"] for r in op2_pii_surrogates(spark, MID).collect()}
    assert before.keys() == after.keys()
    seen, values = {}, set()
    for i, t in before.items():
        found = p.find_entities(t or "")
        values |= {(k, p.normal(k, t[a:b])) for a, b, k in found}
        if not found:
            assert after[i] == t
            continue
        at, shift = 0, 0
        for a, b, k in found:  # the text around entities stays; each entity gets its own surrogate
            assert after[i][at + shift:a + shift] == t[at:a]
            fresh = after[i][a + shift:b + shift]
            if k != "ip":
                assert len(fresh) == b - a
            else:
                fresh = re.match(r"[\d.]*\d", after[i][a + shift:])[0]
                shift += len(fresh) - (b - a)
            assert re.sub(r"\d", "0", fresh) == re.sub(r"\d", "0", t[a:b]) or k in ("email", "ip")
            assert seen.setdefault((k, p.normal(k, t[a:b])), p.normal(k, fresh)) == p.normal(k, fresh)
            at = b
        assert after[i][at + shift:] == t[at:]
    assert len(seen) > 50 and len({(k, f) for (k, _), f in seen.items()}) == len(seen)  # distinct
    assert not {(k, f) for (k, _), f in seen.items()} & values  # nobody gets another's entity
    for (k, v), f in seen.items():
        if k == "card":
            assert (p.luhn(v) == 0) == (p.luhn(f) == 0) and v[0] == f[0]


def test_names_iban_and_case(spark):
    text = "Mrs. Mary Smith and Mr SMITH met Mary Jones; Ольга Иванова wrote to BOB.Lee@Example.com, bob.lee@example.com. " \
           "IBAN GB82 WEST 1234 5698 7654 32, GB82WEST12345698765432, SSN 123-45-6789"
    out = p.replace_entities(spark.createDataFrame([(text,), (None,), ("",), ("Mary had 2 lambs, it is 3.5 at 10:30",)], "text string"))
    got = [r["text"] for r in out.collect()]
    assert None in got and "" in got and "Mary had 2 lambs, it is 3.5 at 10:30" in got
    new = next(t for t in got if t and "IBAN" in t)
    m = re.fullmatch(r"Mrs\. (\w+) (\w+) and Mr (\w+) met (\w+) (\w+); (\w+) (\w+) wrote to (\S+)@(\S+), (\S+)@(\S+)\. "
                     r"IBAN ([A-Z0-9 ]+), ([A-Z0-9]+), SSN (9\d\d-\d\d-\d{4})", new)
    assert m and m[1] == m[4] and m[2].upper() == m[3] and m[2] != m[5]
    assert m[1].endswith(p.SCRIPTS["latin"][3]) and re.fullmatch("[А-Яа-я]+", m[6] + m[7])
    assert m[6].endswith(p.SCRIPTS["cyrillic"][3])
    assert m[8].lower() == m[10] and m[8][:3].isupper() and m[9].lower() == m[11]
    assert m[12].replace(" ", "") == m[13] and p.iban_rest(m[13]) == 1


def test_collisions_draw_again(spark):
    """A drawing with few values still ends with distinct surrogates, none an entity."""
    values = spark.createDataFrame([("card", f"{k}") for k in range(200)], "kind string, value string")
    got = p.assign(values, draw=lambda k, v, attempt, key: str(100 + (int(v) * 7 + attempt * 13) % 400)).collect()
    fresh = [r["fresh"] for r in got]
    assert len(got) == len(set(fresh)) == 200 and not set(fresh) & {str(k) for k in range(200)}
    with pytest.raises(RuntimeError):
        p.assign(values.limit(5), most_rounds=3, draw=lambda *a: "999")


def test_copies_clashing_columns_and_empty_table(spark, tmpdir_path):
    rng = random.Random(1)
    rows = [(k % 5, f"call +1 (98{k % 3}) 555-2485 or me{k % 3}@x.org " + "w " * rng.randrange(5), "v") for k in range(40)]
    rows += [(None, "y" * 100_000 + " 10.1.2.3", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, value string").selectExpr("*", "1 as kind", "2 as text_key")
    out = p.replace_entities(df)
    assert out.columns == df.columns and out.count() == 41
    texts = {r["text"] for r in out.collect()}
    assert not any(re.search(r"555-2485|me\d@x", t) for t in texts)
    assert any(re.search(r"y 10\.\d+\.\d+\.\d+$", t) for t in texts)  # a private address stays private
    assert p.replace_entities(df.limit(0)).count() == 0


def test_entities_once_for_all_copies(spark):
    """Copies of a text add no rows: what is gathered for a text grows with the text alone."""
    df = spark.createDataFrame([("mail a@b.org or +1 212 555 0100",)] * 50 + [("mail a@b.org",)] * 20, "text string")
    found = [tuple(r) for r in p.entities(df.repartition(7)).collect()]
    assert len(found) == len(set(found)) == 3
    out = [r["text"] for r in p.replace_entities(df).collect()]
    assert len(out) == 70 and len(set(out)) == 2 and not any("a@b.org" in t or "555 0100" in t for t in out)


def test_full_spaces_draw_from_wider_ones(spark):
    """All 676 addresses of a shape are entities: none can be another's surrogate."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    values = [("email", f"{a}@{b}.co") for a in letters for b in letters]
    got = [r["fresh"] for r in p.assign(spark.createDataFrame(values, "kind string, value string")).collect()]
    assert len(got) == len(set(got)) == 676 and not set(got) & {v for _, v in values}
    later = [p.surrogate("ip", "192.168.1.2", k) for k in range(p.WIDER, 64)]
    assert any(not x.startswith("192.168.") for x in later) and all(re.fullmatch(p._OCTET + rf"(?:\.{p._OCTET}){{3}}", x) for x in later)
    assert p.written_like("123-45-6789", "ssn", p.surrogate("ssn", "123456789", 8)).startswith("9")
    iban = p.surrogate("iban", "ES9121000418450200051332", 9)
    assert len(iban) == 24 and p.iban_rest(iban) == 1


def found(text):
    return [(text[a:b], k) for a, b, k in p.find_entities(text)]


def test_iban_before_other_tokens_and_inside_rejected():
    for iban in ("ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "BE68 5390 0754 7034", "NO93 8601 1117 947"):
        for tail in (" EUR", " BIC BKAUATWW", " 2024", " INVOICE 12", ". Paid", ""):
            assert (iban, "iban") == found(f"to {iban}{tail}")[0], iban + tail
    assert found("XX12 GB82 WEST 1234 5698 7654 32") == [("GB82 WEST 1234 5698 7654 32", "iban")]
    assert found("ref AB12 4111 1111 1111 1111 end") == [("4111 1111 1111 1111", "card")]
    assert found("+1 212-555-1234 2024 1234 5678")[0] == ("212-555-1234", "phone")


def test_bare_mentions_capitals_and_all_letters(spark):
    text = "Smith's plan: Mr John Smith met JOHN and Smith-Jones. The smith forged; Smithson stayed. Dr Łukasz Żak, later Żak. " \
           "MRS MARY JONES. Jones' hat. MS WORD-BOOK. MS Word. Mr Şahin. ΓΙΩΡΓΟΣ ΠΑΠΑΣ, Γιώργος Παπάς"
    got = found(text)
    assert [v for v, _ in got] == ["Smith", "John", "Smith", "JOHN", "Smith", "Jones", "Łukasz", "Żak", "Żak", "MARY", "JONES", "Jones",
                                   "WORD-BOOK", "Şahin", "ΓΙΩΡΓΟΣ", "ΠΑΠΑΣ", "Γιώργος", "Παπάς"]
    assert sorted(p.find_entities(text)) == p.find_entities(text)
    out = p.replace_entities(spark.createDataFrame([(text,)], "text string")).first()["text"]
    assert not any(n in out.replace("Smithson", "") for n in ("Smith", "John", "JOHN", "Żak", "MARY", "Jones", "JONES", "Şahin", "Παπάς"))
    assert "The smith forged; Smithson stayed." in out and "MS Word. Mr " in out
    first, last, first_again, last_again = p.plain_name(out.replace(",", "")).split()[-4:]
    assert first == first_again and last == last_again
    assert found("Mr De La Cruz. De la casa, La vida") == [("De", "male"), ("La", "surname")]


def test_long_unbroken_runs_take_linear_time():
    import time
    for run in ("a" * 5_000_000, "a@" + "b" * 5_000_000, "a1b2" * 1_000_000, "x-y_z." * 500_000, "9" * 2_000_000):
        start = time.perf_counter()
        p.find_entities(run)
        assert time.perf_counter() - start < 20
    at = "..-joe.x@mail.example.org"
    assert [(at[a:b], k) for a, b, k in p.find_entities(at)] == [("joe.x@mail.example.org", "email")]
    assert [(k, "see a@b@c.org,x@y"[a:b]) for a, b, k in p.find_entities("see a@b@c.org,x@y")] == [("email", "b@c.org")]
