from collections import Counter

from helpers import SMALL, rows_of

from shelfwise.llm import queries, rules


def plain_repeats(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    return len(covered)


def test_repeated_words():
    for text in (
        "", "a b c d", "a " * 30, "a b c d e a b c d e", "a b c d e f g a b c d e", "x a b c d e y a b c d e z",
        "a b " * 9, " ".join(map(str, range(300))) * 2, " ".join(map(str, range(300))) + " " + " ".join(map(str, range(300))),
    ):
        assert rules.repeat_words(text.split()) == plain_repeats(text.split())


PROSE = "This is a sentence of the text. It says something, and then it ends."


def test_lines():
    fails = {
        "Home | News | Sport | About": True,
        "Über | uns | und | mehr | a": True,
        "word%%% noise### more*** of%%% it&&&": True,
        "THIS IS SHOUTED!!": True,
        "a line without any sentence mark": True,
        "the the the the the the the the the.": True,
        "All rights reserved.": True,
        PROSE: False,
        "Short": False,
        "He said: \"It is done.\"": False,
        "Released under the MIT License.": False,
        "1 2 3.": False,
    }
    for line, want in fails.items():
        words = rules.WORD.findall(line)
        ends = rules.sentence_ends([line])[0]
        assert rules.line_fails(line, words, sum(map(len, words)), ends) is want, line


WRAPPED = (
    "This is prose that was wrapped at a fixed\nwidth, so that most of its lines hold no end of\n"
    "a sentence at all. They go on\n\u201cin lower case\u201d in the next\nline, and that ends here."
)


def test_wrapped_prose_and_other_stops():
    assert rules.judge(WRAPPED).kept and rules.judge(WRAPPED).lost_chars == 0
    for stop in ("\u0964", "\u061f", "\u06d4", "\u1362", "\u3002", "\uff01"):
        text = f"\u0939\u0940 \u0915\u094b \u0928\u0947 \u092e\u0947 \u0938\u0947{stop} " * 2
        assert rules.judge(text.strip()).lost_chars == 0, stop
    # Lines that go on nowhere still fail, and a blank line ends what goes on.
    assert rules.sentence_ends(["a b c d", "e f g h", "", "i j k.", "L m n o", "p q r s."]) == [
        False, False, True, True, True, True
    ]
    assert rules.judge("one two three four\nfive six seven eight\nnine ten eleven twelve").lost_chars > 0


def test_documents(spark):
    rows = [
        (1, None), (2, ""), (3, PROSE), (4, f"{PROSE}\nAll rights reserved.\n\n{PROSE}"), (None, PROSE), (3, PROSE),
        (5, "Home | News | Sport | About | More | Even more\n" + PROSE), (6, "a\x0bb\x1cc  d"), (7, PROSE + " " + "w%%% " * 40),
        (8, "\n".join(f"Word{i} says w{i} and then x{i} too." for i in range(20000))),
    ]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n_chars int, kept string, n_words int")
    got = {(r.doc_id, r.n_words): r for r in rules.judged(frame).collect()}
    assert rules.judged(frame).count() == len(rows)
    assert not got[1, 0].kept and not got[2, 0].kept and got[3, 14].kept
    twice = next(r for k, r in got.items() if k[0] == 4)
    assert twice.cleaned == f"{PROSE}\n" and not twice.kept
    assert got[6, 3].word_chars == 5
    assert next(r for k, r in got.items() if k[0] == 8).kept
    dotted = frame.withColumnRenamed("kept", "a.b")
    assert rules.cleaned(dotted).columns == dotted.columns and rules.cleaned(dotted).count() == 4
    clean = rules.cleaned(frame)
    assert clean.columns == frame.columns and clean.schema["n_chars"].dataType.simpleString() == "int"
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted([3, 3, None, 8], key=repr)
    assert rules.cleaned(frame.limit(0)).count() == 0


def test_query_counts_equal_brute_force(spark):
    want = []
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        words = [w for w in _words(r.text)]
        lines = [x for x in r.text.split("\n") if _words(x)]
        want.append((
            r.doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in r.text),
            len(lines) - len(set(lines)), plain_repeats(words),
        ))
    got = queries.op5_quality_rules(spark, SMALL).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
    )
    assert rows_of(got) == sorted(want, key=repr)


def _words(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]
