"""Known values of the text functions."""

import random
import re

import unicodedata

import pytest
from pyspark.sql import functions as F

from trackforge.functions import dates, lucene, matching, nested, splitting, text


def value(spark, column, **row):
    """A column's value over one row of string columns."""
    df = spark.range(1).select(*(F.lit(v).cast("string").alias(k) for k, v in row.items()))
    return df.select(column.alias("x")).first().x


def values(spark, function, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.x for r in df.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]


CASES = {
    text.normalize_text: [("Native  Instruments", "native instruments"), ("Artist’s Song", "artist s song"), ("", None), (None, None), ("MӨЯIS BLΛK", "moris blak"), ("!!!", "!!!"), ("Naté", "nate")],
    text.strip_track_number: [("06-Dinosaur Jr.", "Dinosaur Jr."), ("3. Song Title", "Song Title"), ("0713 Invoking the Muse", None), ("2 Chainz", None), ("12-", None), ("1-800-273-8255", "800-273-8255")],
    text.artist_variations: [
        ("Grimes feat Janelle Monáe", ["grimes feat janelle monáe", "grimes feat janelle monae", "grimes"]),
        ("†HR33ΔM", ["†hr33δm", "thr33am", "hr33δm", "hr33am"]),
        ("A★Teens", ["a★teens", "a teens"]),
        ("G feat J and featuring U", ["g feat j and featuring u", "g feat j", "g"]),
        ("", []),
        (None, []),
        ("GIMS/L2B", ["gims/l2b", "gims l2b", "gims", "l2b"]),
        ("the feather boa band", ["the feather boa band", "feather boa band", "the"]),
    ],
    text.conservative_variations: [("The Cure", ["The Cure", "Cure"]), ("06-The Cure", ["06-The Cure", "The Cure", "Cure"]), ("  ", []), ("Prince", ["Prince"])],
    text.clean_title: [
        ("Complex (Clean) [Official Music Video] - Explicit", "Complex"),
        ("(Clean)", "(Clean)"),
        ("Song (Not a Version)", "Song (Not a Version)"),
        ("Song - Single Ladies", "Song Ladies"),
        ("Song - Edit", "Song"),
        ("Song - Edited", "Song - Edited"),
        ("", None),
    ],
    text.collapse_repeated_brackets: [("Title (A) (A) (B) (B)", "Title (A) (B)"), ("Song (Edit) (EDIT)", "Song (Edit)"), ("Song [Remix] (Remix)", "Song (Remix)"), ("X" + " (a)" * 1000, "X (a)"), ("", ""), (None, None)],
    text.title_key: [("a feat. b", "a feat. b"), ("a ft. b", "a feat. b"), ("a featuring b", "a feat b"), ("Youth & Young  Manhood ", "youth and young manhood")],
    text.version_base: [("Song (Radio Edit)", "Song"), ("A (b) [c]", "A (b)"), ("Song", None), ("(x)", None)],
    text.valid_uuid: [("", False), ("not-a-uuid", False), ("12345", False), (None, False), ("b10bbbfc-cf9e-42e0-be17-e2c3e1d2600d", True), ("{b10bbbfccf9e42e0be17e2c3e1d2600d}", True), ("b10bbbfc-cf9e-42e0-be17-e2c3e1d2600z", False)],
    text.clean_identifiers: [(" a;b,, c\0 ", ["a", "b", "c"]), (" ; ", None), (None, None)],
    text.sanitize_query: [('a"b\\c', 'a\\"b\\\\c'), (None, "")],
    splitting.split_artists: [
        ("Rapper feat MC", ["Rapper feat MC"]),
        ("AC/DC", ["AC/DC"]),
        ("MC 900 Ft Jesus", ["MC 900 Ft Jesus"]),
        ("Luke Combs, Brooks & Dunn", ["Luke Combs", "Brooks & Dunn"]),
        ("SLANDER Presents Tony, Toni, Toné & The Family Stone", ["SLANDER", "Tony, Toni, Toné & The Family Stone"]),
        ("Kendrick Lamar feat. SZA", ["Kendrick Lamar", "SZA"]),
        ("DJ X; MC Y", ["DJ X", "MC Y"]),
        ("Will Smith, & Kool Moe Dee", ["Will Smith", "Kool Moe Dee"]),
        ("Someone w/ Other", ["Someone", "Other"]),
        ("  ", ["  "]),
    ],
    splitting.comma_parts: [("A, B, & C", ["A", "B", "C"]), ("A", None), ("A, ", None)],
    dates.year_of: [("1999-01-02", 1999), ("12", None), ("x 2001 y", 2001), ("21999", None), (None, None)],
    dates.days_before_2100: [("2002-09-07", 35545), ("", 0), ("x", 0), (None, 0), ("2002-13-40", 35433), ("2100-01-01", 0)],
    matching.has_marker: [("olive", False), ("live at x", True), ("", False)],
}


@pytest.mark.parametrize("function", CASES, ids=lambda f: f.__name__)
def test_values(spark, function):
    inputs, wanted = zip(*CASES[function])
    assert values(spark, function, inputs) == list(wanted)


def test_sized_and_tight_names(spark):
    assert values(spark, lambda c: text.normalize(c, sizecheck=4, nospaces=True), ["abc", "Run-D.M.C."]) == ["TEXT IS TOO SMALL IGNORE", "rundmc"]
    assert values(spark, text.norm_no_article, ["The Danse Society", "Danse Society", None]) == ["dansesociety", "dansesociety", ""]


def test_artist_prefix_and_features(spark):
    cut = lambda t, a: value(spark, text.drop_artist_prefix(F.col("t"), F.col("a")), t=t, a=a)
    assert cut("The Hillbilly Moon Explosion – Call Me", "the hillbilly moon explosion") == "Call Me"
    assert cut("Jay-Z Song", "Jay") == "Z Song" and cut("Song", None) == "Song" and cut("A.B - x", "A+B") == "A.B - x"
    found = value(spark, text.featured_artists(F.col("t")), t="Song (feat. A & B; with C) [ft. D],")
    assert (found.title, found.artists) == ("Song", ["A", "B", "C"])
    plain = value(spark, text.featured_artists(F.col("t")), t="Song feat. X")
    assert (plain.title, plain.artists) == ("Song feat. X", [])


def test_track_year_falls_through(spark):
    year = lambda a, b, c: value(spark, dates.track_year(F.col("a"), F.col("b"), F.col("c")), a=a, b=b, c=c)
    assert (year("85", "1999", "2001"), year(None, None, "2001-05"), year(None, None, None)) == (1999, 2001, None)


def test_queries_of_the_index(spark):
    q = lambda **k: spark.range(1).select(lucene.recording_query(F.lit('So"ng'), **k).alias("q")).first().q
    assert q(artist_name=F.lit("A"), year=F.lit(2000)) == 'recording:"So\\"ng" AND artist:"A" AND firstreleasedate:[1999 TO 2001]'
    assert q(artist_name=F.lit("A"), artist_ids=F.array(F.lit("x"))) == 'recording:"So\\"ng" AND (arid:x)'
    assert q(artist_name=F.lit("A"), artist_id_groups=F.array(F.array(F.lit("x")), F.array().cast("array<string>"))) == 'recording:"So\\"ng" AND arid:x'
    assert q(artist_name=F.lit("A"), artist_id_groups=F.array(F.array().cast("array<string>"))) == 'recording:"So\\"ng"'


def test_nested_documents(spark):
    schema = (
        "c array<struct<name:string,joinphrase:string,artist:struct<id:string>>>, g array<struct<name:string,count:int>>, l array<struct<label:struct<type:string,name:string>>>,"
        "r array<struct<target_type:string,type:string,url:struct<resource:string>>>"
    )
    row = (
        [("A", " feat. ", ("1",)), ("X", " & ", None), ("B", None, ("2",))], [("rock", 2), ("pop", None), ("jazz", 5), ("folk", 2)],
        [((None, "self"),), (("Imprint", "Good"),)], [("url", "home", ("a",)), ("url", "home", ("b",)), ("label", "x", ("c",)), ("url", "wiki", ("d",))],
    )
    df = spark.createDataFrame([row, ([], [], [], []), (None, None, None, None)], schema)
    found = df.select(
        nested.credit_ids(F.col("c")).alias("ids"), nested.credit_string(F.col("c")).alias("artist"), nested.genre_names(F.col("g")).alias("genres"), nested.tag_names(F.col("g")).alias("tags"),
        nested.first_label(F.col("l")).alias("label"), nested.link_map(F.col("r")).alias("links"),
    ).collect()
    assert tuple(found[0]) == (["1", "2"], "A feat. B", ["jazz", "rock", "folk", "pop"], ["rock", "pop", "jazz", "folk"], "Good", {"home": "a", "wiki": "d"})
    assert found[1].artist is None and found[1].genres is None and found[2].label is None


def test_credits(spark):
    ok = lambda artist, names, join="": spark.range(1).select(matching.credits_match(F.lit(artist), F.array(*map(F.lit, names)).cast("array<string>"), F.lit(join)).alias("x")).first().x
    assert ok("Danse Society", ["The Danse Society"]) and not ok("Kelly", ["Vance Kelly"])
    assert ok("Prince & The Revolution", ["Prince", "The Revolution"], " & ") and not ok("Prince", ["Prince", "The Revolution"], " & ")
    assert ok("Usher", ["Usher", "Lil Jon"], " feat. ") and not ok("A", []) and not ok("A", ["Various Artists"]) and ok("!!", ["x"]) is False


def test_repeated_brackets_equal_the_fixpoint(spark):
    r = random.Random(5)
    titles = ["".join(r.choice(("(a)", "[A]", "(b)", "(", ")", "[", "]", "a", "b", " ", "x")) for _ in range(r.randrange(1, 16))) for _ in range(600)]
    pair = re.compile(r"[\(\[]([^\)\]]+)[\)\]]\s*[\(\[]\1[\)\]]", re.I)

    def fixpoint(t):
        while (left := pair.sub(r"(\1)", t)) != t:
            t = left
        return t.strip()

    df = spark.createDataFrame([(t,) for t in titles], "t string")
    found = [x[0] for x in df.select(text.collapse_repeated_brackets(F.col("t"))).collect()]
    assert found == [fixpoint(t) for t in titles]


def test_letters_are_spelt_out(spark):
    # characters that are old enough for every version of the tables, and whose kind has not changed
    odd = [chr(c) for c in [*range(0xA0, 0x3400), *range(0xF900, 0xFFF0), *range(0x1D400, 0x1D800)] if unicodedata.ucd_3_2_0.category(chr(c)) not in ("Cn", "Cs", "Co") and c != 0x1734]
    drop, blank = {"Mn", "Me", "Lm", "Sc", "Sk", "No"}, {"So", "Sm", "Cc", "Cf", "Mc"}

    def expected(t):
        letters = "".join(x for x in unicodedata.normalize("NFKD", t.lower()) if unicodedata.category(x) != "Mn").lower()
        kept = (x for x in letters if unicodedata.category(x) not in drop)
        return " ".join("".join(" " if unicodedata.category(x) in blank or unicodedata.category(x)[0] in "PZ" else x for x in kept).split()) or None

    df = spark.createDataFrame([(i, f"a{c}b") for i, c in enumerate(odd)], "i int, t string")
    found = {r.t: r.p for r in df.select("t", text.plain(F.col("t")).alias("p")).collect()}
    wrong = {t: (found[t], expected(t)) for t in found if found[t] != expected(t)}
    assert found["aﬁb"] == "afib" and found["a½b"] == expected("a½b")
    assert not wrong
    assert all(re.search(text.UNCOMMON, c) for c in text._ligatures()[1])


def test_nested_repeated_brackets_come_to_an_end(spark):
    def plainly(title):
        while True:
            new = re.sub(r"[\(\[]([^\)\]]+)[\)\]]\s*[\(\[]\1[\)\]]", r"(\1)", title, flags=re.I)
            if new == title:
                return title.strip()
            title = new

    r = random.Random(9)
    nested = "x"
    for i in range(12):
        nested = f"({nested} ({'ab'[i % 2]}) [{'ab'[i % 2]}])({nested})"[:4000]
    titles = [nested] + ["".join(r.choice(["(", ")", "[", "]", "a", "A", " "]) for _ in range(40)) for _ in range(300)] + ["(a)" * 500, "((((a)(a)(a)(a)"]
    assert values(spark, text.collapse_repeated_brackets, titles) == [plainly(t) if t else t for t in titles]
