import ipaddress
import re
import time
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dailybars.llm.pseudonyms import Feistel, Pseudonyms, luhn, pseudonymised, rewritten

KEY = b"test key"


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation(n):
    feistel = Feistel(KEY)
    image = [feistel.permute(x, n, "t") for x in range(n)]
    assert sorted(image) == list(range(n))
    assert [feistel.permute(y, n, "t", back=True) for y in image] == list(range(n))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 10**30), st.integers(0, 10**30))
def test_reversible(n, x):
    feistel = Feistel(KEY)
    x %= n
    assert feistel.permute(feistel.permute(x, n, "t"), n, "t", back=True) == x


CASES = {
    "card": ("4111 1111 1111 1111", r"\d{4} \d{4} \d{4} \d{4}"),
    "ip": ("97.51.17.173", r"\d+\.\d+\.\d+\.\d+"),
    "date": ("2024-02-29", r"\d{4}-\d\d-\d\d"),
    "ssn": ("123-45-6789", r"\d{3}-\d\d-\d{4}"),
    "phone": ("+1 (017) 555-7713", r"\+1 \(\d{3}\) \d{3}-\d{4}"),
    "email": ("and.34@mail7.example.com", r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com"),
    "secret": ("04dbebab91ab85687d33eeaaf9ac699e1188f962", r"[0-9a-f]{40}"),
    "iban": ("GB82 WEST 1234 5698 7654 32", r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d"),
}


@pytest.mark.parametrize("kind", CASES)
def test_format_and_links(kind):
    value, pattern = CASES[kind]
    text, spans = Pseudonyms(KEY).rewrite(f"see {value}, and again {value}.")
    assert [s[0] for s in spans] == [kind, kind]
    new = re.fullmatch(rf"see ({pattern}), and again (\1)\.", text)
    assert new and value not in text
    assert Pseudonyms(b"another").rewrite(value)[0] != new.group(1)
    # A pseudonym is valid itself.
    assert [s[0] for s in Pseudonyms(KEY).rewrite(new.group(1))[1]] == [kind]


def test_validation():
    rewrite = Pseudonyms(KEY).rewrite
    for text in (
        "9807915762804491 fails its check digit", "300.1.2.3", "2023-02-29", "000-12-3456", "Version 2.0 of 12345",
        "GB83 WEST 1234 5698 7654 32", "page 23904", "a@b", "3.14159", "1,234,567", "x4111111111111111",
    ):
        assert rewrite(text) == (text, [])


def test_same_card_in_two_formats_stays_linked():
    a, _ = Pseudonyms(KEY).rewrite("4111111111111111")
    b, _ = Pseudonyms(KEY).rewrite("4111-1111-1111-1111")
    assert a == b.replace("-", "") and luhn(a) == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dates(min_value=__import__("datetime").date(1900, 1, 1), max_value=__import__("datetime").date(2099, 12, 31)), max_size=5))
def test_dates(days):
    made = Pseudonyms(KEY)
    for day in days:
        iso, european = made.rewrite(day.isoformat())[0], made.rewrite(f"{day:%d/%m/%Y}")[0]
        assert iso == "-".join(reversed(european.split("/")))


def test_table(spark, small_docs, odd_docs, no_docs):
    made = Pseudonyms(KEY)
    for docs in (small_docs, odd_docs, no_docs):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        want = [(d, None if t is None else made.rewrite(t)[0], 0 if t is None else len(made.rewrite(t)[1])) for d, t in rows]
        got = [tuple(r) for r in pseudonymised(docs, KEY).select("doc_id", "text", "n_found").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        full = rewritten(docs, KEY)
        assert full.columns == docs.columns
        assert sorted(str(r["text"]) for r in full.collect()) == sorted(str(t) for _, t, _ in want)


def test_nothing_of_the_known_kinds_is_left_as_it_was(small_docs):
    rows = small_docs.select("doc_id", "text").collect()
    new = {r["doc_id"]: r["text"] for r in pseudonymised(small_docs, KEY).collect()}
    seen = 0
    for r in rows:
        for value in re.findall(r"\S+@\S+\.com|\b\d+\.\d+\.\d+\.\d+\b|\(\d{3}\) \d{3}-\d{4}|[0-9a-f]{40}", r["text"]):
            seen += 1
            assert value not in new[r["doc_id"]]
    assert seen


@pytest.mark.parametrize(
    "value, kind, after",
    [
        ("4111 1111 1111 1111", "card", " 12/27"),
        ("4111111111111111", "card", " 123"),
        ("4111-1111-1111-1111", "card", ".Next"),
        ("4111 1111 1111 1111", "card", "-x"),
        ("DE89370400440532013000", "iban", " EUR 50"),
        ("GB82 WEST 1234 5698 7654 32", "iban", " BIC X"),
        ("GB82 WEST 1234 5698 7654 32", "iban", ".Next"),
        ("2024-01-05", "date", "T12:00:00Z"),
        ("2024-01-05", "date", ".Next"),
        ("97.51.17.173", "ip", ".Next"),
        ("123-45-6789", "ssn", "-x"),
        ("+1 (017) 555-7713", "phone", ".Next"),
        ("+1 (017) 555-7713", "phone", " 2024 12"),
    ],
)
def test_what_follows_does_not_hide_a_value(value, kind, after):
    text, spans = Pseudonyms(KEY).rewrite(f"see {value}{after} here")
    assert spans[0] == (kind, 4, 4 + len(value))
    assert value not in text and text == f"see {Pseudonyms(KEY).rewrite(value)[0]}{after} here"


def test_a_continuing_number_is_no_value():
    rewrite = Pseudonyms(KEY).rewrite
    for text in ("1.2.3.4.5", "2024-01-05-07", "2024-01-05Tx", "123-45-6789-1", "97.51.17.173x", "GB83 WEST 1234 5698 7654 32 BIC X"):
        assert rewrite(text) == (text, [])


@pytest.mark.parametrize("value", ["3f" * 1800, "ab12" * 250_000, "q" * 3_100 + "@mail.example.com", "a1.b" * 200_000 + "@x.org"])
def test_values_of_any_length_in_linear_time(value):
    started = time.time()
    new, spans = Pseudonyms(b"k").rewrite(f"see {value} end")
    assert time.time() - started < 30
    assert len(new) == len(value) + 8 and new != f"see {value} end" and [(a, b) for _, a, b in spans] == [(4, 4 + len(value))]
    assert Pseudonyms(b"k").rewrite(f"and {value}")[0][4:] == new[4:-4]


@pytest.mark.parametrize("text", ["7" * 1_000_000, "x" * 1_000_000, "1 " * 300_000, "1:2:" * 200_000, "a.b" * 300_000])
def test_long_runs_that_are_no_values(text):
    started = time.time()
    Pseudonyms(b"k").rewrite(text)
    assert time.time() - started < 60


def test_blocks_depend_on_what_is_before_them():
    tail = "0123456789abcdef" * 40
    one, two = (Pseudonyms(b"k").rewrite(head + tail)[0] for head in ("a" * 256, "a" * 255 + "b"))
    assert one[300:] != two[300:]
    assert len({Pseudonyms(b"k").rewrite("a" * 256 + tail[:-1] + c)[0] for c in "0123456789abcdef"}) == 16


def test_month_first_dates_stay_month_first():
    rewrite = Pseudonyms(b"k").rewrite
    written = {}
    for ordinal in range(date(2000, 1, 1).toordinal(), date(2003, 1, 1).toordinal()):
        day = date.fromordinal(ordinal)
        if day.day > 12:
            new = rewrite(day.strftime("%m/%d/%Y"))[0]
            month, of_month, _ = map(int, new.split("/"))
            assert month <= 12 < of_month
            written[new] = day
    assert len(written) == sum(date.fromordinal(d).day > 12 for d in range(date(2000, 1, 1).toordinal(), date(2003, 1, 1).toordinal()))


def test_other_digits_are_left_alone():
    arabic = "٤١١١ ١١١١ ١١١١ ١١١١"
    assert Pseudonyms(b"k").rewrite(f"no. 5, {arabic}")[0].endswith(arabic)


def test_ipv6():
    rewrite = Pseudonyms(b"k").rewrite
    for value in ("2001:db8:85a3:0:0:8a2e:370:7334", "fe80::1ff:fe23:4567:890a", "FE80::0202:B3FF:FE1E:8329"):
        new, spans = rewrite(f"from {value}, again {value}")
        one = new.split()[1].rstrip(",")
        assert [kind for kind, *_ in spans] == ["ipv6", "ipv6"] and new.endswith(one) and one != value
        assert [len(g) for g in one.split(":")] == [len(g) for g in value.split(":")]
        ipaddress.IPv6Address(one)
    for text in ("at 12:30:45 sharp", "ratio 1:2:3", "std::vector::size", "1:2:3:4:5:6:7:8:9"):
        assert rewrite(text) == (text, [])
