"""Cards and IBANs beside other digits and words."""

import re

import pytest
from test_llm_pii import luhn, mod97, permute, run

CARD, IBAN, BELGIAN = "4111 1111 1111 1111", "ES9121000418450200051332", "BE68 5390 0754 7034"


@pytest.fixture(scope="module")
def results(spark):
    return dict(zip(TEXTS, run(spark, [before + value + after for before, value, after in TEXTS])))


TEXTS = [("", "4111111111111111", " 12/25"), ("", CARD, " 123"), ("2 ", CARD, ""), ("1234 ", CARD, ""), ("7 ", CARD, " 123"),
         ("", "411111 1111111111", " 12/25"), ("", "3782 822463 10005", " 1234"), ("no 12-", CARD.replace(" ", "-"), "-01"),
         ("", IBAN, " EUR"), ("", BELGIAN, " BIC"), ("AB12 ", BELGIAN, " KREDBEBB"), ("to ", IBAN, " TOTAL 5")]


@pytest.mark.parametrize("parts", TEXTS)
def test_only_the_valid_part(results, parts):
    before, value, after = parts
    kind, got = "iban" if value[0].isalpha() else "card", results[parts]
    assert list(got["kinds"]) == [kind]
    new = got["text"][len(before):len(before) + len(value)]
    assert got["text"] == before + new + after and new != value
    old, plain = (re.sub("[ -]", "", x) for x in (value, new))
    if kind == "card":
        assert luhn(plain) == 0 and plain[:-1] == permute(old[:-1], "card")
    else:
        assert mod97(plain) == 1 and plain[4:] == permute(old[4:], "iban")


def test_a_failed_match_hides_nothing(spark):
    texts = ["100 2020-01-31 2020-02-01", f"{CARD} {CARD}", "1990 1991 1992 1993 1994 1995 1996 1997 1998", "9 " * 400]
    dates, cards, years, digits = run(spark, texts)
    assert list(dates["kinds"]) == ["date"] * 2 and list(cards["kinds"]) == ["card"] * 2
    assert cards["text"][:19] == cards["text"][20:]
    assert len(years["text"]) == len(texts[2]) and len(digits["text"]) == len(texts[3])
