import csv
import io

from hypothesis import given, settings
from hypothesis import strategies as st

from fieldloom.operators.packed import COUNTS, FEED_LAYOUTS, LOCATIONS, THEMES, TONE, PackedLayout, split_packed, unpack_fields


def test_themes():
    assert split_packed("A_B,1;C,2;;;D;", THEMES) == ["A_B,1", "C,2", "D"]
    assert split_packed('"TAX; WORLD,267" | AB,306 |CD , 5', THEMES) == ["TAX; WORLD,267", "AB,306", "CD,5"]
    assert split_packed("AB CD  EF", THEMES) == ["AB", "CD", "EF"]
    assert split_packed("AB,1,CD,2, EF", THEMES) == ["AB,1", "CD,2", "EF"]
    assert split_packed("AB,1\tCD,2\nEF,3", THEMES) == ["AB,1", "CD,2", "EF,3"]
    for absent in (None, "", "  ", "None", " None "):
        assert split_packed(absent, THEMES) == []


def test_locations_and_counts():
    assert split_packed('1#F#LI#LI##-3.4#27.7#LI,"4#N ""Old"", K#KE#KE1##1#2#3",2#A, B#C', LOCATIONS) == ["1#F#LI#LI##-3.4#27.7#LI", '4#N "Old", K#KE#KE1##1#2#3', "2#A, B#C"]
    assert split_packed('KILL#2#women, children#4#X, Y#A#B,WOUND#1;"D#4#goats; cattle"', COUNTS) == ["KILL#2#women, children#4#X, Y#A#B", "WOUND#1", "D#4#goats; cattle"]


def test_tone():
    assert split_packed("-1.5,2.25,3", TONE) == ["-1.5", "2.25", "3"]
    assert split_packed('"-1,5","2,25",3', TONE) == ["-1,5", "2,25", "3"]
    assert split_packed("-1,5; 2,25;3", TONE) == ["-1,5", "2,25", "3"]
    assert split_packed("-1,5|2,25|3", TONE) == ["-1,5", "2,25", "3"]
    assert split_packed("-1.5,,2.25,,3,", TONE) == ["-1.5", "2.25", "3"]
    assert split_packed("-1.5 2.25 3", TONE) == ["-1.5", "2.25", "3"]


def test_open_quotes_brackets_and_escapes():
    nested = PackedLayout(hard=";", brackets="([", escape="\\")
    assert split_packed('a;"b;c', nested) == ["a", '"b', "c"]
    assert split_packed("f(x;y);[1;(2;3)];z", nested) == ["f(x;y)", "[1;(2;3)]", "z"]
    assert split_packed("(a;b", nested) == ["(a", "b"]
    assert split_packed(r"a\;b;c", nested) == ["a;b", "c"]
    assert split_packed('x "q" y;z', nested) == ['x "q" y', "z"]
    assert split_packed('"a\\"b;c";d', nested) == ['a"b;c', "d"]
    assert split_packed("(a;[b;c);d];e", nested) == ["(a;[b;c)", "d]", "e"]
    assert split_packed(r"\(a;b);(c;d)", nested) == ["(a", "b)", "(c;d)"]
    assert split_packed('(x;"a (b";c);d', nested) == ['(x;"a (b";c)', "d"]
    assert split_packed(");(a", nested) == [")", "(a"] and len(split_packed("(a;" * 20000, nested)) == 20000
    assert len(split_packed("(" * 50000 + ")" * 50000 + ";b", nested)) == 2


def test_feed_fields_with_brackets_and_escapes():
    assert split_packed("AB,1;CD(EF; GH),2,IJ,3", THEMES) == ["AB,1", "CD(EF; GH),2", "IJ,3"]
    assert split_packed("4#Old Town (north; by the river), Kelimot#KE#KE1##1#2#3;2#A [B|C]#D", LOCATIONS) == ["4#Old Town (north; by the river), Kelimot#KE#KE1##1#2#3", "2#A [B|C]#D"]
    assert split_packed(r"KILL#2#men\; women#4#X;WOUND#1#{a;b}", COUNTS) == ["KILL#2#men; women#4#X", "WOUND#1#{a;b}"]
    assert split_packed("KILL#2#men (armed#4#X;WOUND#1", COUNTS) == ["KILL#2#men (armed#4#X", "WOUND#1"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='ab;|" ,', min_size=1, max_size=8).map(str.strip).filter(bool), max_size=6))
def test_round_trip(values):
    out = io.StringIO()
    csv.writer(out, delimiter=";", quoting=csv.QUOTE_ALL, lineterminator="").writerow(values)
    assert split_packed(out.getvalue(), PackedLayout(hard=";")) == values


def test_rows(spark):
    rows = [("r1", "A,1;B,2", None, "1.5,2", "None", 1), (None, "A,1", "", "", "", 2)]
    df = spark.createDataFrame(rows, "gkgrecordid string, v2themes string, v2locations string, v2tone string, counts string, pos int")
    got = {(r.gkgrecordid, r.field, r.pos, r.item) for r in unpack_fields(df, "gkgrecordid", FEED_LAYOUTS).collect()}
    assert got == {("r1", "v2themes", 1, "A,1"), ("r1", "v2themes", 2, "B,2"), ("r1", "v2tone", 1, "1.5"), ("r1", "v2tone", 2, "2"), (None, "v2themes", 1, "A,1")}
    assert unpack_fields(df.limit(0), "gkgrecordid", FEED_LAYOUTS).count() == 0
