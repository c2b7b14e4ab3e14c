import random
import re

import pytest
from pyspark.sql import functions as F

from sievewright.contracts import SPECIAL_CHARACTERS, contract_from_names
from sievewright.functions import checks, dates, identity, text

C = None


@pytest.fixture(autouse=True)
def the_column(spark):
    global C
    C = F.col("c")


def column(rows):
    return [r[0] for r in rows]


def test_blank_to_null(texts):
    assert column(texts(["", "  ", " a ", None], text.blank_to_null(C))) == [None, None, " a ", None]


def test_title_words(texts):
    given = ["  customer   7 ", "NULL", "none", "Nan", "o'neil mary-jane", "a\tb", "", None, "NA"]
    expected = ["Customer 7", None, None, None, "O'neil Mary-jane", "A B", None, None, "Na"]
    assert column(texts(given, text.title_words(C))) == expected


def test_title_letters_is_python_title(texts):
    given = ["o'neil mary-jane", "abc1def x", "small   business", "a.b", "ÉCOLE d'été", "x--y"]
    expected = [" ".join(g.split()).title() for g in given]
    assert column(texts(given, text.title_letters(C))) == expected


def test_title_letters_tokens_in_exact_case(texts):
    assert column(texts(["NULL", "Null", "nan", "NAN", " x "], text.title_letters(C))) == [
        None, "Null", None, "Nan", "X"]


def test_upper_id(texts):
    assert column(texts([" x 1", "none", None, "a\n b"], text.upper_id(C))) == ["X 1", None, None, "A B"]


def test_strip_currency_and_special(texts):
    assert column(texts(["$1,200", "€ 5 ", "₿7", None], text.strip_currency(C))) == ["1200", "5", "7", None]
    assert column(texts(["Cust​omer ", SPECIAL_CHARACTERS + "x"], text.strip_special(C))) == ["Customer", "x"]


def test_nbsp_survives_trim(texts):
    assert column(texts([" x"], text.title_words(C))) == [" x"]


def test_null_tokens(texts):
    given = ["NA", "Na", "n/a", " nan ", "Canada", "", "none", "None", None]
    assert column(texts(given, text.is_null_token(C))) == [True, True, True, True, False, True, True, True, False]
    assert column(texts(given, text.is_null_token(C, case_sensitive=True))) == [
        True, False, True, True, False, True, True, False, False]


def test_spelled_numbers(texts):
    cases = {
        "twenty one": "21", "one hundred and five": "105", "two thousand three hundred ten": "2310",
        "one million two hundred thousand and six": "1200006", "Forty-Two": "42", "three point one four": "3.14",
        "zero": "0", "hundred": "100", "x12": "x12", "12": "12", "Abc": "Abc", "thousand million": "thousand million",
        "hundred hundred": "hundred hundred", "one point": "one point",
    }
    assert column(texts(list(cases), text.spelled_number("c"))) == list(cases.values())
    assert column(texts([None], text.spelled_number("c"))) == [None]


def random_dates(n):
    rng = random.Random(7)
    out = ["2024-02-30", "2024-02-29", "+12024-01-01", "-2024-01-05", "20240131", "99999999", "2024/31/12", "March", "",
           "05-01--2024", "05-01-+12024", "2024-1-5", "03-04-2024", "0000-01-01", None, " 2024-01-01"]
    for _ in range(n):
        a, b = rng.randint(0, 14), rng.randint(0, 33)
        y = rng.choice([1, 99, 1970, 2024, 12024])
        sep = rng.choice(["-", "/", "", "."])
        parts = rng.choice([(f"{y:04d}", f"{a:02d}", f"{b:02d}"), (f"{a:02d}", f"{b:02d}", f"{y:04d}"),
                            (f"{b:02d}", f"{a:02d}", f"{y:04d}"), (str(y), str(a), str(b))])
        out.append(sep.join(parts))
    return out


def test_parse_multi_equals_the_seven_formats(texts):
    formatted = F.coalesce(*[F.try_to_date(C, f) for f in dates.DAY_FIRST_FORMATS])
    rows = texts(random_dates(400), C, dates.parse_multi(C, signed_years=True).cast("string"), formatted.cast("string"))
    assert [r for r in rows if r[1] != r[2]] == []


def test_ambiguous_date_is_day_first(texts):
    assert column(texts(["03-04-2024", "12-31-2024"], dates.parse_multi(C).cast("string"))) == ["2024-04-03", "2024-12-31"]


def test_parse_strict(texts):
    from datetime import datetime

    def expected(value):
        for f in ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%Y/%m/%d", "%d-%m-%Y", "%m-%d-%Y"):
            try:
                return datetime.strptime(value.strip(), f).strftime("%Y-%m-%d").zfill(10)
            except ValueError:
                continue
        return None

    given = [g for g in random_dates(300) if g]
    rows = texts(given, C, dates.parse_strict(C).cast("string"))
    assert [(r[0], r[1], expected(r[0])) for r in rows if r[1] != expected(r[0]) and "0000" not in r[0]] == []


def test_strict_issue(texts):
    given = ["2024-1-5", "next week", "2024.01.05", "null", "", None, "31/12/2024"]
    assert column(texts(given, dates.strict_issue(C))) == [
        None, "dynamic_or_partial", "unparseable", None, None, None, None]


def test_parse_permissive(texts):
    given = ["2013.05.07", "7 May 2013", "May 7, 2013", "20130507", "2013-05-07 10:00:00", "next week", "Mayonnaise 7 2013"]
    assert column(texts(given, dates.parse_permissive(C).cast("string"))) == ["2013-05-07"] * 5 + [None, None]


def test_char_rule_equals_its_three_patterns(texts):
    rng = random.Random(3)
    alphabet = "aB3 -.,;:()_/\t\n!&é​ "
    given = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6))) for _ in range(1500)]
    rows = texts(given, C, checks.char_bad("c"), checks.char_issue("c"))
    allowed = re.compile(r"^(?:[a-zA-Z0-9\s.,;:()_/]|(?<!\s)-(?!\s))+$", re.ASCII)
    for value, bad, issue in rows:
        if any(ch in value for ch in SPECIAL_CHARACTERS):
            expected = "Contains special char in c"
        elif re.search(r"\A[^a-zA-Z0-9]|[^a-zA-Z0-9]\Z", value):
            expected = "Invalid leading/trailing char in c"
        elif not allowed.match(value):
            expected = "Invalid characters in c"
        else:
            expected = None
        assert (bad, issue) == (expected is not None, expected), repr(value)


def test_nonpositive_ops(texts):
    given = ["0", "-3", "5", "x", None, "-0.5"]
    assert column(texts(given, checks.nonpositive("c", "<="))) == [True, True, False, False, False, True]
    assert column(texts(given, checks.nonpositive("c", "<"))) == [False, True, False, False, False, True]


def test_type_bad(spark, texts):
    contract = contract_from_names({"c": "date"})
    f = contract.fields[0]
    given = ["2024/12/31", "2024/31/12", "99999999", "2024-02-30", "2024-01-05", "March", None]
    assert column(texts(given, checks.type_bad(f))) == [True, False, False, False, False, True, False]
    assert column(texts(given, checks.type_bad(f, "parse"))) == [False, True, True, True, False, True, False]
    number = contract_from_names({"c": "int64"}).fields[0]
    assert column(texts(["12", "12.5", "$1,200", "x", None], checks.type_bad(number, currency=True))) == [
        False, True, False, True, False]
    other = contract_from_names({"c": "datetime64[ns]"}).fields[0]
    assert column(texts(["2024-01-01 10:00:00", "soon", None], checks.type_bad(other))) == [False, True, False]


def test_suggestions_skip_dictionary_values(texts):
    near = checks.typo_suggestions("c", ("West", "East"))
    assert column(texts(["west", "Wst", "far away", None], near)) == [[], ["West", "East"], [], []]
    parity = checks.typo_suggestions("c", ("West", "East"), flag_valid=True)
    assert column(texts(["west"], parity)) == [["East"]]


def test_row_hash_null_handling(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = column(df.select(identity.row_hash(df.columns)).collect())
    safe = column(df.select(identity.row_hash(df.columns, null_safe=True)).collect())
    assert plain[0] == plain[1] and safe[0] != safe[1]


def test_dates_in_any_usual_notation(texts):
    from datetime import date

    from sievewright.functions.dates import parse_permissive

    day = date(2024, 3, 5)
    expected = {
        "2024-03-05": day, "2024/3/5": day, "2024.03.05": day, "20240305": day, "2024 3 5": day, "3/5/2024": day, "05-03-2024": day, "3.5.2024": day,
        "13/3/2024": date(2024, 3, 13), "3-13-2024": date(2024, 3, 13), "13.3.2024": date(2024, 3, 13), "03/05/24": day, "5-3-69": date(1969, 3, 5),
        "5-3-68": date(2068, 3, 5), "5 March 2024": day, "5. MARCH 2024": day, "March 5, 2024": day, "mar 5 2024": day, "5-Mar-24": day, "Mar-05-2024": day,
        "2024-mar-05": day, "2024 March 5": day, "Tue, 5 Mar 2024": day, "Tuesday, March 5th, 2024": day, "Thurs. 5 sept 2024": date(2024, 9, 5),
        "the 5th of March 2024": None, "5th of March 2024": day, "1st may 2024": date(2024, 5, 1), "2nd Aug 2024": date(2024, 8, 2),
        "2024-03-05 10:20": day, "2024-03-05T10:20:30Z": day, "2024-03-05 10:20:30.123+02:00": day, "3/5/2024 11:05 PM": day, "5 Mar 2024, 9:00 am": day,
        "2024-03-05 24:00": None, "2024-03-05 10:60": None, "3/5/2024 13:05 PM": None, "2024-02-30": None, "29 February 2023": None,
        "29 Feb 2024": date(2024, 2, 29), "31/31/2024": None, "0/5/2024": None, "2024-13-05": None, "March 2024": None, "2024": None, "5 March": None, "5/3": None,
        "5/3-2024": None, "5 Foo 2024": None, "marchy 5 2024": None, "5 March 024": None, "123 March 2024": None, "202403": None, "20241345": None, "": None, "  ": None,
        "next week": None, "1/2/3/4": None, "5 March 2024 x": None, "5 March 20245": None, None: None, "  2024-03-05  ": day,
    }
    got = texts(list(expected), "c", parse_permissive(F.col("c")))
    assert {c: d for c, d in got} == expected
