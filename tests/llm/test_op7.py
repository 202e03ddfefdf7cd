import re

from hypothesis import given, settings
from hypothesis import strategies as st

from pubmill.llm.op7_personal_data import BASE, find, luhn, masked, mod97, personal_data, redact

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), "email", m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), "ip", m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), "card", m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and plain_luhn(digits(m))]
    out += [(m.start(), "phone", m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[0], BASE.index(s[1])))


PIECES = st.sampled_from(["a", "Z9", ".", "@", "-", "+", " ", "1", "255", "256", "10.0.0.1", "4111111111111111", "49", "(", ")", "x@y.z", "é", "%", "_", "\n", "٣"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(PIECES, max_size=24))
def test_base_spans_equal_plain_patterns(pieces):
    text = "".join(pieces)
    assert [(a, k, b) for a, k, b, _ in find(text) if k in BASE] == brute(text)


def test_checksums_and_added_kinds():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("GB82WEST12345698765432") and not mod97("GB83WEST12345698765432")
    assert [s[1] for s in find("my bank account GB82 WEST 1234 5698 7654 32.")] == ["iban"]
    assert find("GB82 WEST 1234 5698 7654 32 alone") == []
    assert masked("mail a.b@c.de or 10.0.0.1!") == "mail [EMAIL] or [IP]!"


def test_digits_that_stand_apart():
    for text, kind in [("8.8.8.8", "ip"), (" ".join("4111111111111111"), "card"), ("-".join("4111111111111111"), "card"), ("+1 2 3 4 5 6 7 8 9 0", "phone")]:
        assert (5, kind, 5 + len(text)) in [s[:3] for s in find(f"ping {text} now")]
        assert [s[:3] for s in find(f"ping {text} now")] == brute(f"ping {text} now")
    assert masked("ping 8.8.8.8 now") == "ping [IP] now"
    assert [s[:3] for s in find("0" * 5000 + ".1.2.3")] == [(0, "ip", 5006)]


def test_iban_before_a_word_in_capitals():
    for code in ("ES91 2100 0418 4502 0005 1332", "GB82 WEST 1234 5698 7654 32"):
        for after in ("", " THIS", " THIS WORD", " TO", " this"):
            assert [s[:3] for s in find(f"bank {code}{after}") if s[1] == "iban"] == [(5, "iban", 5 + len(code))]
    assert [s for s in find("bank ES92 2100 0418 4502 0005 1332 THIS") if s[1] == "iban"] == []


def test_long_texts_are_linear():
    assert find("a" * 2_000_000 + "@") == [] and find("1" * 500_000 + ".") == []


def test_rows(spark):
    rows = [(1, "write a@b.co"), (1, "write a@b.co"), (None, "é 10.1.2.3"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as spans")
    got = sorted((str(r.doc_id), [(s.kind, s.start, s.end) for s in r.spans]) for r in personal_data(docs).collect())
    assert got == [("1", [("email", 6, 12)])] * 2 + [("3", []), ("4", []), ("None", [("ip", 2, 10)])]
    assert sorted(str(r.text) for r in redact(docs).collect()) == ["", "None", "write [EMAIL]", "write [EMAIL]", "é [IP]"]
    assert redact(docs).columns == docs.columns
    assert personal_data(docs.limit(0)).count() == 0


def test_context_words_are_whole_words():
    score = lambda text: find(text)[0][3]
    assert score("host 10.0.0.1") == score("HOST: 10.0.0.1") == 0.75
    assert score("description 10.0.0.1 ghosts") == 0.5 and score("hotel, basically +1 234 567 8901") == 0.5
    assert score("Visa: 4111111111111111") == 0.95


def test_whole_table_equals_plain_patterns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans if s.kind in BASE] for r in personal_data(docs).collect()}
    assert got == {r.doc_id: brute(r.text or "") for r in docs.collect()} and any(got.values())
