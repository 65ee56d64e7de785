import datetime
import time

import pytest

from samples import ODD, SF, docs_of, none, odd  # noqa: F401

from themewell.llm import pseudonyms as P

KEY = b"0123456789abcdef"


@pytest.mark.parametrize("size", [1, 2, 3, 10, 100, 257, 1000])
def test_permutations(size):
    image = [P.permute(i, size, KEY, b"t") for i in range(size)]
    assert sorted(image) == list(range(size))
    assert [P.permute(v, size, KEY, b"t", back=True) for v in image] == list(range(size))
    if size >= 100:
        assert image != [P.permute(i, size, KEY, b"u") for i in range(size)] != [P.permute(i, size, b"x" * 16, b"t") for i in range(size)]


VALID = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "3782-822463-10005"],
    "ssn": ["078-05-1120", "899-99-9999", "001-01-0001", "667-01-0001", "665-99-9999"],
    "ip": ["1.2.3.4", "255.255.255.255", "0.0.0.0"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "date": ["2024-02-29", "31.12.1999", "2/3/2001", "12/31/2000", "1900-01-01"],
    "phone": ["+1 (743) 555-3824", "+49 30 1234567", "555-123-4567", "(555) 123-4567"],
    "email": ["hein.19@mail5.example.com", "A_b+c@x.org"],
}


@pytest.mark.parametrize("kind,value", [(k, v) for k, vs in VALID.items() for v in vs])
def test_format_stays_and_goes_back(kind, value):
    new = P.pseudonym(kind, value, KEY)
    assert new != value and P.pseudonym(kind, new, KEY, back=True) == value
    assert P._FORMS[kind].fullmatch(new) and P.find(f"so {new}, yes") == [(3, 3 + len(new), kind)]
    shape = lambda v: "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in v)
    if kind not in ("ip", "date", "iban"):
        assert shape(new) == shape(value)


@pytest.mark.parametrize("kind,value", [("card", "4111111111111112"), ("card", "0000000000000000"), ("ssn", "666-01-0001"),
    ("ssn", "000-01-0001"), ("ip", "256.1.1.1"), ("ip", "01.1.1.1"), ("iban", "DE88370400440532013000"), ("date", "2023-02-29"),
    ("date", "13/13/2000"), ("date", "1899-12-31"), ("phone", "555123")])
def test_invalid_values_stay(kind, value):
    assert P._VALUE[kind](value, KEY) is None


def test_all_days_permute_among_days():
    days = [datetime.date.fromordinal(P.FIRST_DAY + i).isoformat() for i in range(0, P.DAYS, 97)]
    assert len({P.pseudonym("date", d, KEY) for d in days}) == len(days)


def test_equal_values_stay_linked_and_texts_go_back(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in P.pseudonymize(spark.read.parquet(f"{SF}/documents.parquet"), KEY).collect()}
    seen = {}
    for d in docs:
        r = got[d.doc_id]
        new, spans = P.replace(d.text, KEY)
        assert r.text == new and r.n_replaced == len(spans)
        assert r.spans == ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert P.replace(new, KEY, back=True)[0] == d.text
        for a, b, k in spans:
            value = d.text[a:b]
            assert value not in new or d.text.count(value) == 0
            seen.setdefault((k, value), set()).add(P.pseudonym(k, value, KEY))
        if not spans:
            assert new == d.text
    assert seen and all(len(v) == 1 for v in seen.values())


def test_clean_texts_stay():
    for text in ("in 1999 there were 12,345,678 of 3.14159", "version 1.2.3 and 10.0", "A1B2C3D4 0xdeadbeef", "page 12-34-5678901",
                 "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "1234567890123456", "x@y", "1.2.3.4.5", "room (12) 345"):
        assert P.replace(text, KEY) == (text, [])


def test_odd_rows(odd, none):
    rows = P.pseudonymize(odd, KEY).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in rows) == sorted((i or -1, t or "") for i, t, *_ in ODD)
    assert {r.text for r in rows if r.doc_id == 1} == {None}
    assert P.pseudonymize(none, KEY).collect() == []
    with pytest.raises(ValueError):
        P.pseudonymize(odd, b"short")


WHOLE = {
    "date": ["1984-03-12T10:30:00Z", "2001-12-31T2359", "1999-01-01T00:00:00+02:00"],
    "iban": ["TR330006100519786457841326", "EE382200221020145685", "LT121000011101001000", "LV80BANK0000435195001", "SI56263300012039086",
             "HR1210010051863000160", "BG80BNBG96611020345678", "CY17002001280000001200527600", "MT84MALT011000012345MTLCAST001S",
             "IS140159260076545510730339", "LI21088100002324013AA", "AE070331234567890123456", "SA0380000000608010167519",
             "BR1800360305000010009795493C1"],
    "phone": ["020 7946 0958", "06 12 34 56 78", "01632 960 001", "030/1234567", "(020) 7946 0958", "02 555 12 12", "01 23 45 67 89", "0171.123.4567"],
}


@pytest.mark.parametrize("kind,value", [(k, v) for k, vs in WHOLE.items() for v in vs])
def test_timestamps_other_countries_and_national_numbers(kind, value):
    text = f"so {value}, yes"
    new, spans = P.replace(text, KEY)
    assert [k for _, _, k in spans] == [kind] and new != text
    start, end, _ = spans[0]
    assert (start, end) == (3, 13 if kind == "date" else 3 + len(value))
    assert len(new) == len(text) and new[end:] == text[end:] and P.replace(new, KEY, back=True)[0] == text


def test_national_numbers_permute_among_themselves():
    values = [f"0{n} {m:03d} 45 67" for n in range(1, 10) for m in range(0, 1000, 37)]
    image = [P.pseudonym("phone", v, KEY) for v in values]
    assert len(set(image)) == len(values) and all(P.find(v) == [(0, len(v), "phone")] for v in image)
    shaped = [f"0{n} {m} 8901 {x}" for n in range(123, 133) for m in range(4000, 4010) for x in ("2", "23", "2345")]
    for v in [*shaped, "06 12 34 56 78 2024", "020 7946 0958 12345678", "01 2345 6789 0123 4"]:
        assert P.replace(P.replace(v, KEY)[0], KEY, back=True)[0] == v
    for text in ("0.12 0.345 0.6789", "001 002 003 004", "1984-03-12Tuesday"):
        assert P.replace(text, KEY) == (text, [])


def test_a_day_has_one_pseudonym_in_all_spellings():
    for i in range(0, P.DAYS, 61):
        day = datetime.date.fromordinal(P.FIRST_DAY + i)
        y, m, d = day.year, day.month, day.day
        new = datetime.date.fromisoformat(P.pseudonym("date", day.isoformat(), KEY))
        spellings = {
            f"{d:02d}.{m:02d}.{y}": f"{new.day:02d}.{new.month:02d}.{new.year}",
            f"{m:02d}/{d:02d}/{y}": f"{new.month:02d}/{new.day:02d}/{new.year}",
            f"{m}/{d}/{y}": f"{new.month}/{new.day}/{new.year}",
            f"{y}/{m}/{d}": f"{new.year}/{new.month}/{new.day}",
        }
        if d > 12:
            spellings[f"{d:02d}/{m:02d}/{y}"] = f"{new.day:02d}/{new.month:02d}/{new.year}"
        for old, want in spellings.items():
            assert P.pseudonym("date", old, KEY) == want
            assert P.pseudonym("date", want, KEY, back=True) == old


def test_every_day_of_a_sort_is_reached_once():
    days, places = P._days()
    assert sorted(d for sort in days for d in sort) == list(range(P.DAYS))
    assert all(days[s][k] == d for d, (s, k) in enumerate(places))


def test_many_values_take_time_in_proportion():
    text = " ".join(f"on {1950 + i % 90}-0{1 + i % 9}-1{i % 10} we met;" for i in range(20_000))
    began = time.process_time()
    assert len(P.find(text)) == 20_000 and time.process_time() - began < 5
