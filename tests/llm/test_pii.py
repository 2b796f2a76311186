import time
import hashlib
import re

import pytest

from basketmart.llm.pii import _luhn, find_pii, hidden_spans, op8_deobfuscated_pii, plain_spans, redact, redact_documents

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def brute(text):
    """The contract's patterns as they are written."""
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                True,
                all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                12 <= len(digits) <= 19 and _luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@pytest.mark.parametrize(
    "text",
    [
        "",
        "a@b.c d@@e.f.g x@y a.b@c-d.e1.f@g.h @k.l",
        "1.2.3.4.5.6.7.8 1..2.3.4.5 256.1.1.1 001.002.003.255 999.1.2.3.4",
        "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 0 0 0 0 0 0 0 0 0 0 0 0",
        "+1 (386) 555-3733 ou +1234567 ++49 (0)89.123456 x +12345678901234567",
        "élan a@b.de, 10.0.0.1\n10.0.0.1.\n+33 1 23 45 67 89",
        "1234567890" * 50 + "@" * 20 + "a" * 500 + "@" + "b." * 30 + "c",
    ],
)
def test_plain_spans_are_those_of_the_patterns(text):
    assert plain_spans(text) == brute(text)


def test_random_strings(rng=None):
    import random

    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice("ab1 2.3@+-()4é%") for _ in range(rng.randrange(60)))
        assert plain_spans(text) == brute(text)


@pytest.mark.parametrize(
    "text, source",
    [
        ("mail jo.doe [at] example [dot] com now", "jo.doe [at] example [dot] com"),
        ("mail jo(at)example.com now", "jo(at)example.com"),
        ("write jo at example dot com please", "jo at example dot com"),
        ("mail jо@exаmple.com now", "jо@exаmple.com"),
        ("call plus one two one two five five five zero one nine nine today", "plus one two one two five five five zero one nine nine"),
        ("call +１２１２５５５０１９９ today", "+１２１２５５５０１９９"),
        ("mail j​o@example.com now", "j​o@example.com"),
    ],
)
def test_disguises_map_back_to_the_source(text, source):
    plain = plain_spans(text)
    spans = sorted(plain + hidden_spans(text, plain))
    assert source in [text[a:b] for a, _, b in spans]


@pytest.mark.parametrize(
    "text, source",
    [
        ("card four" + " one" * 15 + " now", "four" + " one" * 15),
        ("card 4111 1111 1111 111 one now", "4111 1111 1111 111 one"),
        ("call plus one one one one two two two two one now", "plus one one one one two two two two one"),
        ("jo [at  ] example [\tdot ] com now", "jo [at  ] example [\tdot ] com"),
        ("mail jo at example.com now", "jo at example.com"),
        ("mail jo at mail dot example.app now", "jo at mail dot example.app"),
        ("mail jo dot doe at example dot nl now", "jo dot doe at example dot nl"),
        ("mail jo@example dot us now", "jo@example dot us"),
        ("mail jo (at) example dot ru now", "jo (at) example dot ru"),
        ("mail jo  at  a dot b dot c dot d dot e dot f dot g dot ai.", "jo  at  a dot b dot c dot d dot e dot f dot g dot ai"),
        ("host one nine two dot one six eight dot one dot one now", "one nine two dot one six eight dot one dot one"),
        ("host 10 dot 0 dot zero.one now", "10 dot 0 dot zero.one"),
        ("host one zero [dot] 0 [dot] 0 [dot] one now", "one zero [dot] 0 [dot] 0 [dot] one"),
    ],
)
def test_mixed_disguises(text, source):
    plain = plain_spans(text)
    spans = sorted(plain + hidden_spans(text, plain))
    assert source in [text[a:b] for a, _, b in spans]
    assert source not in redact(text)


def test_more_long_texts_take_linear_time():
    for text in ("a dot " * 20_000, "a at " * 20_000, "x at a" + ".b1" * 60_000, "one dot " * 20_000, "1 " * 60_000 + "one", "one" + " " * 90_000, "plus " * 20_000):
        hidden_spans(text, [])


@pytest.mark.parametrize("text", ["look at the polka dot dress", "one or two (at most) three dots", "Éa què at en dot", "at one two"])
def test_clean_texts_have_no_finds(text):
    assert plain_spans(text) == [] and hidden_spans(text, []) == []


def test_long_texts_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + " " * 200_000, "one " * 20_000, "[at]" * 20_000):
        plain = plain_spans(text)
        hidden_spans(text, plain)


def test_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a@b.co a@b.co", "x"), (3, "a@b.co a@b.co", "x"), (None, "10.0.0.1", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((tuple(r) for r in find_pii(docs).collect()), key=str)
    empty = hashlib.sha256(b"").hexdigest()
    two = "email:0:6,email:7:13"
    want = [
        (1, 0, 0, 0, 0, empty, ""),
        (2, 0, 0, 0, 0, empty, ""),
        (3, 2, 0, 0, 0, hashlib.sha256(two.encode()).hexdigest(), two),
        (3, 2, 0, 0, 0, hashlib.sha256(two.encode()).hexdigest(), two),
        (None, 0, 1, 0, 0, hashlib.sha256(b"ip:0:8").hexdigest(), "ip:0:8"),
    ]
    assert got == sorted(want, key=str)
    assert find_pii(docs.limit(0)).count() == 0


def test_redaction(spark):
    assert redact("jo [at] b [dot] com, 10.0.0.1.") == "<EMAIL>, <IP>."
    docs = spark.createDataFrame([(1, "to a@b.co", 9, "k"), (2, None, None, None)], "doc_id long, text string, n_chars long, k string")
    assert [tuple(r) for r in redact_documents(docs).collect()] == [(1, "to <EMAIL>", 10, "k"), (2, None, None, None)]


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in op8_deobfuscated_pii(spark, folder).collect():
        plain = brute(texts[r.doc_id] or "")
        listed = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in plain)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.n_email == sum(k == 0 for _, k, _ in plain) and r.n_phone == sum(k == 3 for _, k, _ in plain)
        assert set(listed.split(",")) <= set(r.spans.split(","))


def test_blanks_beside_a_bracket_take_linear_time():
    text = "jo" + " " * 100_000 + "[at]" + "\t " * 50_000 + "example.org"
    start = time.perf_counter()
    assert [(a, b) for a, kind, b in hidden_spans(text, [])] == [(0, len(text))]
    assert time.perf_counter() - start < 2
    start = time.perf_counter()
    hidden_spans("x" + " " * 200_000 + "y [at] z", [])
    assert time.perf_counter() - start < 1


@pytest.mark.parametrize(
    "text",
    [
        "+٤٩ ٣٠ ١٢٣٤٥٦٧٨",
        "+𝟜𝟡 𝟛𝟘 𝟙𝟚𝟛𝟜𝟝𝟞𝟟𝟠",
        "plus vier neun drei null eins zwei drei vier fünf sechs",
        "plus trois trois un deux trois quatre cinq six sept huit",
        "plus tres cuatro uno dos tres cuatro cinco seis siete ocho",
    ],
)
def test_digits_of_other_scripts_and_languages(text):
    assert hidden_spans(f"Tel: {text}.", []) == [(5, 3, 5 + len(text))]


def test_mathematical_letters_are_letters():
    assert hidden_spans("𝒋𝒐@example.org", []) == [(0, 0, 14)]
