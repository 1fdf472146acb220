import random
import re

import pytest

from linkscore.llm import pseudonyms as P

PERMUTE = P.Permutation(b"key of the test")
TEXT = (
    "nt.26@mail6.example.com 4845168114407329, 4111 1111 1111 1111 10.20.3.255 +1 (389) 555-5010!! 2024-02-29 12/31/1999 "
    "31/12/1999 123-45-6789 DE89 3704 0044 0532 0130 00; GB82WEST12345698765432 555-123-4567"
)
KINDS = ["email", "card", "card", "ip", "phone", "date", "date", "date", "ssn", "iban", "iban", "phone"]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 256, 1000])
def test_a_permutation_of_any_size(n):
    assert sorted(PERMUTE.apply(k, n, "x") for k in range(n)) == list(range(n))


def test_other_keys_give_other_values():
    assert PERMUTE.apply(5, 10**9, "x") != P.Permutation(b"other").apply(5, 10**9, "x")
    assert PERMUTE.apply(5, 10**9, "x") == P.Permutation(b"key of the test").apply(5, 10**9, "x")


def test_every_kind_is_found_and_stays_valid():
    found = P.find(TEXT, PERMUTE)
    assert [x[2] for x in found] == KINDS
    again = P.replaced(TEXT, found)
    assert [x[2] for x in P.find(again, PERMUTE)] == KINDS and len(again) == len(TEXT)
    shape = lambda x: re.sub(r"[a-z]", "a", re.sub(r"\d", "9", x))
    for a, b, kind, new in found:
        old = TEXT[a:b]
        assert new != old
        if kind != "email":
            assert shape(new) == shape(old)
        if kind == "card":
            digits = re.sub(r"\D", "", new)
            assert P.luhn_digit(digits[:-1]) == digits[-1] and digits[0] == "4"


@pytest.mark.parametrize("decoy", [
    "9807915762804490", "4845168114407320", "999.1.1.1", "1.2.3.4.5", "2023-02-30", "000-12-3456", "666-12-3456", "v1.2.3", "DE89370400440532013001",
    "12345", "3.14", "file.name@", "@user", "x4845168114407329", "00000000",
])
def test_decoys_stay(decoy):
    assert P.find(f"a {decoy} b", PERMUTE) == []


def test_each_format_maps_one_to_one():
    rng = random.Random(3)

    def card():
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return digits + P.luhn_digit(digits)

    makers = {
        P._card: card,
        P._ip: lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
        P._ssn: lambda: f"{rng.choice([1, 5, 665, 667, 899]):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}",
        P._date: lambda: f"{rng.randint(1, 31):02d}/{rng.randint(1, 31):02d}/{rng.randint(1900, 2099)}",
        P._email: lambda: f"{rng.choice('abc')}{rng.randrange(99)}.X@m{rng.randrange(9)}.example.com",
    }
    for make, draw in makers.items():
        seen = {}
        for _ in range(1500):
            value = draw()
            new = make(value, PERMUTE)
            if new is not None:
                assert make(new, PERMUTE) is not None and len(new) == len(value)
                seen[value.lower()] = new.lower()
        assert len(set(seen.values())) == len(seen)


def test_table(spark):
    rows = [(1, TEXT, "x", 7), (1, TEXT, "x", 7), (2, None, "x", 7), (3, "", "x", 7), (None, "clean text", None, 7), (4, "pad " * 99_999 + "10.20.3.255", "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_card int")
    out = sorted(P.pseudonymize(df, b"key of the test").collect(), key=repr)
    by = {r["doc_id"]: r for r in out}
    assert len(out) == 6 and by[2]["text"] is None and by[3]["text"] == "" and by[None]["text"] == "clean text"
    assert by[1]["n_card"] == 2 and by[1]["text"] == P.replaced(TEXT, P.find(TEXT, PERMUTE))
    start, end = map(int, by[4]["spans"].split(":")[1:])
    assert rows[5][1][start:end] == "10.20.3.255" and by[4]["text"][start:end] in by[1]["text"]
    assert P.pseudonymize(df.limit(0), b"k").collect() == []
