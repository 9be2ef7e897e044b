"""Format-preserving pseudonyms for personal data, by a keyed Feistel network.

A match of ``PATTERN`` is replaced only if it is valid for its kind: Luhn for
card numbers, modulo 97 for IBANs, octets up to 255 for addresses, the number
ranges of a social security number, a real day of the calendar for dates.
The replacement is a keyed permutation inside the same format, so it is valid
again, has the same length, and equal values get equal pseudonyms in every
document and in every spelling of one format (separators are kept, not
permuted).  Who has the key can undo it; without it a pseudonym tells only
that two values were equal.

Forms are tried at every place where one begins.  A card or an IBAN may end at
any separator of the longest match there, and a match that is not valid hides
none that begins inside it, so a number next to other digits or words (expiry,
code, currency, BIC) is found.

Two networks of ``ROUNDS`` rounds are used, both loops over a small state
(``aggregate``), so the expression stays small:

* numbers: (l, r) in Z_a x Z_b, in turn l += F(r) mod a and r += F(l) mod b.
  Days (146,097 = 189 * 773, a whole Gregorian cycle, 1800 to 2199) and social
  security numbers (898 * 99 * 9999) are such pairs exactly;
* characters: both halves of a string, each character shifted inside its own
  alphabet (digit, letter, hexadecimal digit) by a keyed stream of the other half.

F is SHA-2 over the key, the kind, the round and the other half.

Only DataFrame functions run here, and a text without a digit or ``@`` is
passed through after one scan.

Defined results: a null text stays null, an empty one empty; repeated rows get
equal results; a null ``doc_id`` and all other columns are carried through
unchanged; an empty table stays empty.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import documents

ROUNDS = 8
#: For tests and registered queries without a secret; anyone can undo its pseudonyms.
DEMO_KEY = "demo key, replace me"
#: Session setting that holds the secret.
KEY_SETTING = "spark.starloom.pseudonym.key"

#: Fixed forms, tried in this order at each place of a text.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,4}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:(?:18|19|20|21)[0-9]{2}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2(?:18|19|20|21)[0-9]{2})(?![0-9A-Za-z/-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])",
}
PATTERN = "|".join(FORMS.values())
#: Every place where a form begins, with its longest match as group 1 (so the forms' own groups count from 2).
STARTS = "(?=(" + PATTERN.replace("\\2", "\\3").replace("\\1", "\\2") + "))"
#: Usual spellings of a card by issuer; then any in groups of four digits or more, or 4-3-3-3.
_ISSUER = "(?:2[2-7]|[3-6][0-9])"
USUAL_CARD = (_ISSUER + r"[0-9]{11,17}|(?:2[2-7]|4[0-9]|5[1-5])[0-9]{2}(?:[ -][0-9]{4}){3}"
              r"|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5}|3[0689][0-9]{2}[ -][0-9]{6}[ -][0-9]{4}")
SPELT_CARD = "(?=" + _ISSUER + r")(?:[0-9]{4,}(?:[ -][0-9]{4,})*(?:[ -][0-9]{1,3})?|[0-9]{4}(?:[ -][0-9]{3}){3})"
#: Length of an IBAN: the countries that have it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU", 31: "MT SC", 32: "LC"}
EXACT_IBAN = "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}[A-Z0-9]{{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
_DAYS_FROM = -62091  # 1800-01-01 as days since 1970-01-01
_DAY_A, _DAY_B = 189, 773
_SSN_A, _SSN_B = 898 * 99, 9999


def _hex_value(s: Column) -> Column:
    return F.conv(s, 16, 10).cast("long")


def _bind(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def permute_pair(left: Column, right: Column, a: int, b: int, kind: str, key: str) -> Column:
    """A keyed permutation of Z_a x Z_b, as a struct (l, r)."""
    def word(i: Column, other: Column) -> Column:
        return _hex_value(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i, other), 256), 1, 15))

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, (s["l"] + word(i, s["r"])) % a).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise((s["r"] + word(i, s["l"])) % b).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                       F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def permute_characters(s: Column, kind: str, key: str, hexadecimal: bool = False) -> Column:
    """A keyed permutation of strings that keeps every character's class and all signs."""
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    alphabets = ["0123456789abcdef", "0123456789ABCDEF"] if hexadecimal else ["0123456789", lower, upper]

    def alphabet(c: Column) -> Column:
        if hexadecimal:
            return F.when(s.rlike("[A-F]"), F.lit(alphabets[1])).otherwise(F.lit(alphabets[0]))
        return (F.when(c.rlike("[0-9]"), F.lit(alphabets[0])).when(c.rlike("[a-z]"), F.lit(alphabets[1]))
                .when(c.rlike("[A-Z]"), F.lit(alphabets[2])).otherwise(F.lit("")))

    def shift(half: Column, other: Column, i: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), F.lit(kind), i, other)
        # one key block per 32 characters, so a value of any length has its stream
        blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.length(half) / 32).cast("int"), F.lit(1)) - 1)
        stream = _bind(seed, lambda x: F.array_join(
            F.transform(blocks, lambda k: F.sha2(F.concat(x, F.lit("|"), k.cast("string")), 512)), ""))

        def move(c: Column, at: Column, keys: Column) -> Column:
            letters = alphabet(c)
            to = (F.instr(letters, c) - 1 + _hex_value(F.substring(keys, at * 4 + 1, F.lit(4)))) % F.length(letters)
            return F.when(letters == "", c).otherwise(F.substring(letters, to.cast("int") + 1, F.lit(1)))
        return _bind(stream, lambda keys: F.array_join(
            F.transform(F.filter(F.split(half, ""), lambda c: c != ""), lambda c, at: move(c, at, keys)), ""))

    def step(p: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, shift(p["l"], p["r"], i)).otherwise(p["l"]).alias("l"),
                        F.when(even, p["r"]).otherwise(shift(p["r"], p["l"], i)).alias("r"))
    half = F.floor(F.length(s) / 2).cast("int")
    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                       F.struct(F.substring(s, F.lit(1), half).alias("l"),
                                F.substring(s, half + 1, F.length(s)).alias("r")), step)
    return _bind(done, lambda d: F.concat(d["l"], d["r"]))


def _spell(template: Column, characters: Column, keep: str) -> Column:
    """The characters in the places of ``template`` that match ``keep``, its other signs as they are."""
    marks = F.filter(F.split(template, ""), lambda c: c != "")
    step = F.aggregate(marks, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), lambda a, c: F.when(
        c.rlike(keep), F.struct(F.concat(a["out"], F.substring(characters, a["at"], F.lit(1))).alias("out"),
                                (a["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["at"].alias("at"))))
    return step["out"]


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits that lack or have a check digit 0 at the end."""
    def value(d: Column, i: Column) -> Column:
        n = d.cast("int")
        return F.when(i % 2 == 1, F.when(n > 4, 2 * n - 9).otherwise(2 * n)).otherwise(n)
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), value)
    return F.aggregate(values, F.lit(0), lambda t, v: t + v)


def _mod97(iban: Column) -> Column:
    """The IBAN's number modulo 97 (country and check digits moved to the end)."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    number = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(number, F.lit(0), lambda t, c: F.when(
        c.rlike("[0-9]"), (t * 10 + F.ascii(c) - 48) % 97).otherwise((t * 100 + F.ascii(c) - 55) % 97))


def _day(m: Column) -> Column:
    """The date of a match as a day number; null if there is no such day."""
    iso = F.concat_ws("-", F.substring(m, 1, 4), F.substring(m, 6, 2), F.substring(m, 9, 2))
    dmy = F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2))
    mdy = F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2))

    def number(s: Column) -> Column:
        return F.unix_date(F.try_to_timestamp(s, F.lit("yyyy-MM-dd")).cast("date"))
    return F.when(m.rlike("^[0-9]{4}"), number(iso)).otherwise(F.coalesce(number(dmy), number(mdy)))


def _date_pseudonym(m: Column, key: str) -> Column:
    at = (_day(m) - F.lit(_DAYS_FROM)).cast("long")
    moved = permute_pair(F.floor(at / _DAY_B), at % _DAY_B, _DAY_A, _DAY_B, "date", key)
    day = _bind(moved, lambda p: F.date_from_unix_date((p["l"] * _DAY_B + p["r"] + F.lit(_DAYS_FROM)).cast("int")))
    iso, sign = m.rlike("^[0-9]{4}"), F.when(m.rlike("^[0-9]{4}"), F.substring(m, 5, 1)).otherwise(F.substring(m, 3, 1))
    day_first = F.unix_date(F.try_to_timestamp(F.concat_ws(
        "-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)), F.lit("yyyy-MM-dd")).cast("date")).isNotNull()

    def spell(d: Column, *forms: str) -> Column:
        x, y, z = (F.date_format(d, f) for f in forms)
        return F.concat(x, sign, y, sign, z)
    return _bind(day, lambda d: F.when(iso, spell(d, "yyyy", "MM", "dd"))
                 .when(day_first, spell(d, "dd", "MM", "yyyy")).otherwise(spell(d, "MM", "dd", "yyyy")))


def _ssn_pseudonym(m: Column, key: str) -> Column:
    """Areas 001-899 without 666, groups 01-99, serials 0001-9999 are numbered without gaps."""
    area, group, serial = (F.substring(m, *p).cast("long") for p in ((1, 3), (5, 2), (8, 4)))
    rank = area - 1 - F.when(area > 666, 1).otherwise(0)
    moved = permute_pair(rank * 99 + group - 1, serial - 1, _SSN_A, _SSN_B, "ssn", key)

    def spell(p: Column) -> Column:
        n = F.floor(p["l"] / 99) + 1
        n = n + F.when(n >= 666, 1).otherwise(0)
        return F.concat_ws("-", F.lpad(n.cast("string"), 3, "0"), F.lpad((p["l"] % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((p["r"] + 1).cast("string"), 4, "0"))
    return _bind(moved, spell)


def _ip_pseudonym(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    moved = _bind(parts, lambda o: permute_pair(F.get(o, F.lit(0)) * 256 + F.get(o, F.lit(1)),
                                                F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3)), 65536, 65536, "ip", key))
    return _bind(moved, lambda p: F.concat_ws(".", F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256))


def _card_pseudonym(m: Column, key: str) -> Column:
    digits = _digits(m)
    body = permute_characters(F.substring(digits, F.lit(1), F.length(digits) - 1), "card", key)
    whole = _bind(body, lambda b: F.concat(b, ((10 - _luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
    return _bind(whole, lambda w: _spell(m, w, "[0-9]"))


def _iban_pseudonym(m: Column, key: str) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    body = permute_characters(F.substring(plain, F.lit(5), F.length(plain)), "iban", key)
    country = F.substring(plain, 1, 2)
    whole = _bind(body, lambda b: F.concat(country, F.lpad((98 - _mod97(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0"), b))
    return _bind(whole, lambda w: _spell(m, w, "[A-Z0-9]"))


def _phone_pseudonym(m: Column, key: str) -> Column:
    """The country code stays; the other digits are permuted."""
    prefix = F.regexp_extract(m, r"^(\+[0-9]{1,3})[ .(-]", 1)
    rest = F.substring(m, F.length(prefix) + 1, F.length(m))
    return F.concat(prefix, _bind(permute_characters(_digits(rest), "phone", key), lambda d: _spell(rest, d, "[0-9]")))


def _email_pseudonym(m: Column, key: str) -> Column:
    """Letters and digits of all but the last label are permuted."""
    last = F.concat(F.lit("."), F.substring_index(m, ".", -1))
    head = F.substring(m, F.lit(1), F.length(m) - F.length(last))
    letters = F.regexp_replace(head, "[^A-Za-z0-9]", "")
    return F.concat(_bind(permute_characters(letters, "email", key), lambda x: _spell(head, x, "[A-Za-z0-9]")), last)


def kind_of(m: Column) -> Column:
    """The kind for which a match is valid; null leaves it as it is."""
    form = {k: m.rlike("^(?:" + p + ")$") for k, p in FORMS.items()}
    octets = F.forall(F.split(m, r"\."), lambda x: x.cast("int") <= 255)
    ssn = ~m.rlike("^(000|666|9)") & (F.substring(m, 5, 2) != "00") & (F.substring(m, 8, 4) != "0000")
    return (F.when(form["email"], F.lit("email"))
            .when(form["iban"] & (_mod97(F.replace(m, F.lit(" "), F.lit(""))) == 1), F.lit("iban"))
            .when(form["date"] & _day(m).isNotNull(), F.lit("date"))
            .when(form["ssn"] & ssn, F.lit("ssn"))
            .when(form["phone"], F.lit("phone"))
            .when(form["ip"] & octets, F.lit("ip"))
            .when(form["card"] & (_luhn_sum(_digits(m)) % 10 == 0), F.lit("card"))
            .when(form["secret"] & m.rlike("[0-9]") & m.rlike("[A-Fa-f]"), F.lit("secret")))


def choice(m: Column) -> Column:
    """(v, kind, loose) for the longest match at a place: the part from its beginning that is valid.

    A card or an IBAN may end at any separator of the match, since a date, a
    code or a word that follows looks like its tail.  A part of a match has to
    be spelt as a card, or to have its country's length; only a whole match
    may be any digits or any country (``loose``).
    """
    card, iban = (m.rlike("^(?:" + FORMS[k] + ")$") for k in ("card", "iban"))
    ends = F.filter(F.sequence(F.length(m), F.lit(13), F.lit(-1)),
                    lambda e: (e == F.length(m)) | F.substring(m, e + 1, F.lit(1)).isin(" ", "-"))
    parts = F.transform(ends, lambda e: F.substring(m, F.lit(1), e))

    def spelt(form: str) -> Column:
        return F.filter(parts, lambda v: v.rlike("^(?:" + form + ")$") & v.rlike("^(?:" + FORMS["card"] + ")$")
                        & (_luhn_sum(_digits(v)) % 10 == 0))

    def chosen(v: Column, kind: Column, loose: Column | None = None) -> Column:
        return F.struct(v.alias("v"), kind.alias("kind"), (F.lit(False) if loose is None else loose).alias("loose"))

    def by_kind(kind: Column) -> Column:
        cards = _bind(F.concat(spelt(USUAL_CARD), spelt(SPELT_CARD)), lambda c: F.when(
            F.size(c) > 0, chosen(F.get(c, F.lit(0)), F.lit("card"))).otherwise(chosen(m, kind, kind.isNotNull())))
        valid = F.filter(parts, lambda v: F.replace(v, F.lit(" "), F.lit("")).rlike("^(?:" + EXACT_IBAN + ")$")
                         & (kind_of(v) == "iban") | (kind_of(v) == "secret"))
        ibans = _bind(valid, lambda c: F.when(F.size(c) > 0, chosen(F.get(c, F.lit(0)), kind_of(F.get(c, F.lit(0)))))
                      .otherwise(chosen(m, kind, kind.isNotNull())))
        return (F.when(kind.isNotNull() & ~kind.isin("card", "iban"), chosen(m, kind))
                .when(card, cards).when(iban, ibans).otherwise(chosen(m, kind)))
    return _bind(kind_of(m), by_kind)


def _walk(c: Column) -> Column:
    """Per place: -1 if its choice is taken, else how many characters of its piece are taken already.

    From left to right; a loose choice gives way to any other that begins
    inside it, and is not tried inside a match that failed.
    """
    def step(a: Column, x: Column) -> Column:
        rival = F.exists(c, lambda y: (y["at"] > x["at"]) & (y["at"] < x["at"] + F.length(x["v"]))
                         & y["kind"].isNotNull() & ~y["loose"])
        take = F.when((x["at"] < a["end"]) | x["kind"].isNull(), False) \
            .when(x["loose"], (x["at"] >= a["failed"]) & ~rival).otherwise(True)
        return _bind(take, lambda on: F.struct(
            F.when(on, x["at"] + F.length(x["v"])).otherwise(a["end"]).alias("end"),
            F.when(on | (x["at"] < a["end"]), a["failed"])
            .otherwise(F.greatest(a["failed"], x["at"] + F.length(x["m"]))).alias("failed"),
            F.concat(a["skip"], F.array(F.when(on, -1).otherwise(F.greatest(a["end"] - x["at"], F.lit(0))))).alias("skip")))
    start = F.struct(F.lit(1).alias("end"), F.lit(1).alias("failed"), F.array().cast("array<int>").alias("skip"))
    return F.aggregate(c, start, step)["skip"]


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    return (F.when(kind == "email", _email_pseudonym(m, key)).when(kind == "iban", _iban_pseudonym(m, key))
            .when(kind == "date", _date_pseudonym(m, key)).when(kind == "ssn", _ssn_pseudonym(m, key))
            .when(kind == "phone", _phone_pseudonym(m, key)).when(kind == "ip", _ip_pseudonym(m, key))
            .when(kind == "card", _card_pseudonym(m, key))
            .when(kind == "secret", permute_characters(m, "secret", key, hexadecimal=True)).otherwise(m))


def pseudonymise_text(text: Column, key: str) -> Column:
    """(text, kinds): the text with its valid matches replaced, and the kinds found."""
    def rebuilt(found: Column) -> Column:
        # the text cut at every place; what lies before the first one is a piece of its own, if there is any
        return _bind(F.split(text, STARTS, -1), lambda g: _bind(F.size(g) - F.size(found), lambda before: _bind(
            F.aggregate(g, F.array(F.lit(1)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.length(p)))),
            lambda at: _bind(F.transform(found, lambda m, i: _bind(choice(m), lambda x: F.struct(
                m.alias("m"), x["v"].alias("v"), x["kind"].alias("kind"), x["loose"].alias("loose"),
                F.get(at, i + before).alias("at"), F.get(g, i + before).alias("piece")))),
                lambda c: _bind(_walk(c), lambda skip: joined(F.when(before > 0, F.get(g, F.lit(0))).otherwise(""), c, skip))))))

    def joined(before: Column, c: Column, skip: Column) -> Column:
        def rest(x: Column, taken: Column) -> Column:
            return F.substring(x["piece"], taken + 1, F.length(x["piece"]))
        return F.struct(
            F.concat(before, F.array_join(F.transform(c, lambda x, i: F.when(
                F.get(skip, i) < 0, F.concat(pseudonym(x["v"], x["kind"], key), rest(x, F.length(x["v"]))))
                .otherwise(rest(x, F.get(skip, i)))), "")).alias("text"),
            F.transform(F.filter(c, lambda x, i: F.get(skip, i) < 0), lambda x: x["kind"]).alias("kinds"))

    none = F.array().cast("array<string>")
    plain = F.struct(text.alias("text"), none.alias("kinds"))
    found = F.regexp_extract_all(text, F.lit(STARTS), F.lit(1))
    return F.when(text.rlike("[0-9@]"), _bind(found, lambda f: F.when(F.size(f) > 0, rebuilt(f)).otherwise(plain))) \
        .otherwise(plain)


def session_key(spark) -> str:
    """The secret of the session (``KEY_SETTING``); the public demonstration key, with a warning, if it has none."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        logging.getLogger(__name__).warning("%s is not set: pseudonyms are made with a public key", KEY_SETTING)
    return key or DEMO_KEY


def pseudonymise(docs: DataFrame, key: str | None = None) -> DataFrame:
    """All rows and columns, with pseudonyms in ``text`` (its length does not change).

    Without a ``key`` the session's is used.
    """
    key = key or session_key(docs.sparkSession)
    return docs.withColumn("text", pseudonymise_text(F.col("text"), key)["text"])


def query(spark, sf_dir: str) -> DataFrame:
    """Per document: what was replaced, by kind, and the new text."""
    rows = documents(spark, sf_dir).select("doc_id", pseudonymise_text(F.col("text"), session_key(spark)).alias("p"))
    def count(kind):
        return F.size(F.filter("p.kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", F.coalesce(F.size("p.kinds"), F.lit(0)).cast("long").alias("n_replaced"),
                       *[count(k) for k in FORMS], F.col("p.text").alias("text"))
