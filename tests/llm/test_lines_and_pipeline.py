import collections
import contextlib
import io
import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import DOCS, empty_docs, odd_docs, odd_rows
from tests.llm.test_tokens import check_packing
from tidewire.llm import line_templates as lt

FOLDER = "/root/testdata/sf0.01"


def masked(line):
    return re.sub("[0-9]+", "<*>", line).strip(" \t\x0b\x0c\r")


def known(line):
    """The line as it is compared, and its number of words."""
    line = line.strip(" \t\x0b\x0c\r")
    words = len(masked(line).split(" ")) - masked(line).count("<*>")
    return (masked(line) if words >= 8 else line), words


def brute(texts):
    """Texts without lines that recur as they are; what templates add is on top of this."""
    homes = collections.defaultdict(set)
    for i, text in texts.items():
        for line in (text or "").split("\n"):
            homes[known(line)[0]].add(i)

    def goes(line, i):
        line, words = known(line)
        found = homes[line]
        enough = 2 if len(line.split(" ")) >= 8 else 20 if words >= 3 else len(texts) + 1
        return len(found) >= enough and min(found) != i

    return {i: [x for x in (t or "").split("\n") if not goes(x, i)] for i, t in texts.items()}


def template_partners(lines, same_tokens=0.8, depth=4, least=8):
    """By all pairs of a leaf: the lines with another that shares so many tokens and so many words behind the leaf's."""
    leaves = collections.defaultdict(list)
    for line in lines:
        tokens = line.split(" ")
        if len(tokens) - line.count("<*>") >= 8:
            leaves[len(tokens), *tokens[:depth]].append((line, tokens))
    out = set()
    for members in leaves.values():
        for k, (a, x) in enumerate(members):
            for b, y in members[:k]:
                same = sum(p == q for p, q in zip(x, y, strict=True))
                if same >= same_tokens * len(x) and same - depth - max(a.count("<*>"), b.count("<*>")) >= least:
                    out |= {a, b}
    return out


def test_recurring_lines_go(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    expected = brute(texts)
    rows = lt.drop_recurring(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        left = collections.Counter(r.text.split("\n")) - collections.Counter(["", *expected[r.doc_id]])
        assert not left and r.n_lines == len(texts[r.doc_id].split("\n"))
    equal = sum(r.text == "\n".join(expected[r.doc_id]) for r in rows)
    assert equal > 0.95 * len(rows)


def test_templates_generalise_variable_fields(spark):
    note = "Report of the station {0} on duty number {1} says {2} about the weather in the north today"
    own = "a line of its own that nobody else has written {0} {0} {0} {0} ever before or since"
    names = ["red", "blue", "green", "white"]
    rows = [(i, f"{own.format(n * (i + 2))}\n{note.format(i, 7 * i, n)}", "en", "s", 1) for i, n in enumerate(names)]
    rows.append((9, "Report of the station keeps silence and has nothing in common with any other line here", "en", "s", 1))
    got = {r.doc_id: r for r in lt.drop_recurring(spark.createDataFrame(rows, DOCS)).collect()}
    assert {i: r.n_dropped for i, r in got.items()} == {0: 0, 1: 1, 2: 1, 3: 1, 9: 0}
    assert got[2].text == own.format("green" * 4)


def test_templates_share_a_leaf_with_a_hot_line(spark):
    """Two templates of equal size and one line of many documents, all with the same first tokens."""
    one = "Notice to all members of the club: {} will speak on trees and rivers in the hall"
    two = "Notice to all members dues of {} are to be paid at once by post or bank"
    hot = "Notice to all members that nothing at all is planned for this week or the next one"
    rows = [(i, text.format(f"n{chr(97 + i % 26)}{chr(97 + i // 26)}"), "en", "s", 1) for i, text in enumerate([one, two] * 20)]
    rows += [(100 + i, hot, "en", "s", 1) for i in range(200)]
    got = {r.doc_id: r.n_dropped for r in lt.drop_recurring(spark.createDataFrame(rows, DOCS)).collect()}
    assert [i for i, n in sorted(got.items()) if not n] == [0, 1, 100]


def test_long_lines_with_words_far_apart(spark):
    """Lines of 64 and 640 tokens in which one token in twenty differs, in more than two of the eight runs."""
    def line(i, n):
        return " ".join(f"x{chr(97 + i)}" if k % 20 == 10 else f"w{chr(97 + k % 26)}{chr(97 + k % 23)}" for k in range(n))

    rows = [(i + n, line(i, n), "en", "s", 1) for n in (64, 640) for i in range(20)]
    got = {r.doc_id: r.n_dropped for r in lt.drop_recurring(spark.createDataFrame(rows, DOCS)).collect()}
    assert [i for i, n in sorted(got.items()) if not n] == [64, 640]


def test_short_lines_recur_later(spark):
    rows = [(i, f"All rights reserved.\nThe.\nunique line number {'x' * i} here", "en", "s", 1) for i in range(25)]
    got = {r.doc_id: r.n_dropped for r in lt.drop_recurring(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[0] == 0 and all(got[i] == 1 for i in range(1, 25))
    few = {r.n_dropped for r in lt.drop_recurring(spark.createDataFrame(rows[:19], DOCS)).collect()}
    assert few == {0}


def test_short_lines_are_generalised(spark):
    """A name in a short line of 90 documents; one document with 90 such lines counts once."""
    names = [f"n{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)]
    rows = [(i, f"Posted by {name} on Monday", "en", "s", 1) for i, name in enumerate(names)]
    rows += [(100 + i, "\n".join(f"Seen with {name} at sea" for name in names[i:]), "en", "s", 1) for i in range(2)]
    got = {r.doc_id: r.n_dropped for r in lt.drop_recurring(spark.createDataFrame(rows, DOCS)).collect()}
    assert [i for i, n in sorted(got.items()) if not n] == [0, 100, 101]


def dropped(spark, rows):
    return {r.doc_id: r.n_dropped for r in lt.drop_recurring(spark.createDataFrame(rows, DOCS)).collect()}


def test_lines_that_agree_by_chance_stay(spark):
    """Prose with a common beginning, rows of numbers, and lines of few words around numbers."""
    lines = [
        "She said that she would like to leave now", "She said that she could like to stay now",
        "She said that she would love to leave here", "1 2 3 4 5 6 7 8", "9 10 11 12 13 14 15 16",
        "on 3 of 7 at 9 by 11 and 13 to 15", "on 4 of 8 at 1 by 12 and 14 to 16",
        "It was said at the time that nothing could be done about the old mill by the river",
        "It was said at the time that everybody would come down to the new bridge in May",
    ]
    assert set(dropped(spark, [(i, x, "en", "s", 1) for i, x in enumerate(lines)]).values()) == {0}


def test_planted_templates_go_and_prose_stays(spark):
    """60 templates with a word or two that vary, each in three documents, among 600 lines of prose."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7)))
    common = [word() for _ in range(40)]
    planted, rows = [], []
    for _ in range(60):
        n = rng.randint(15, 40)
        frame, free = [word() for _ in range(n)], rng.sample(range(4, n), rng.randint(1, 2))
        for _ in range(3):
            planted.append(" ".join(word() + "x" if k in free else w for k, w in enumerate(frame)))
    prose = [" ".join(rng.choices(common, k=rng.randint(8, 20))) for _ in range(600)]
    rows = [(i, x, "en", "s", 1) for i, x in enumerate(planted + prose)]
    gone = dropped(spark, rows)
    hit = sum(gone[i] for i in range(180))
    assert hit >= 0.9 * 120 and all(gone[3 * k] == 0 for k in range(60))
    assert sum(gone[i] for i in range(180, 780)) == 0


def test_similar_lines_against_all_pairs(spark):
    """On the given table and on lines made to have unlike partners: recall of same-token lines at least 0.9."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=5))
    chains = []
    for _ in range(30):
        tokens = [word() for _ in range(30)]
        for _ in range(12):
            # Each line of a chain is like its neighbours only; the leaf's tokens stay.
            tokens = list(tokens)
            for k in rng.sample(range(4, 30), 4):
                tokens[k] = word()
            chains.append(" ".join(tokens))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    for rows in ([(i, x) for i, x in enumerate(chains)], docs):
        expected = template_partners({known(x)[0] for _, t in rows for x in (t or "").split("\n")})
        table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
        lines = spark.createDataFrame([(x,) for x in sorted(expected)], "text string").select(F.xxhash64("text").alias("line"))
        found = lt.recurring_lines(table).join(lines, "line", "left_semi").count()
        assert found >= 0.9 * len(expected), (found, len(expected))


def test_odd_rows(spark):
    docs = odd_docs(spark, "n_lines", "line", "first")
    rows = lt.drop_recurring(docs).collect()
    assert len(rows) == len(odd_rows())
    assert {r.text for r in rows if r.doc_id == 1} == {None} and [r.n_lines for r in rows if r.doc_id == 1] == [0]
    assert [r.n_dropped for r in rows if r.doc_id == 3] == [0, 0]
    kept = lt.dedup_lines(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 1  # the copy without an id is emptied
    assert {r.n_lines for r in kept.collect()} == {"clash"}
    assert lt.drop_recurring(empty_docs(spark)).count() == lt.dedup_lines(empty_docs(spark)).count() == 0


def test_plan_is_native(spark):
    plan = lt.drop_recurring(spark.read.parquet(f"{FOLDER}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_code_for_rows_is_compiled(spark, monkeypatch):
    """No method that Spark generates exceeds the 8,000 bytes above which the JVM only interprets."""
    frames, materialize = [], lt.materialize
    monkeypatch.setattr(lt, "materialize", lambda df, name: frames.append(df) or materialize(df, name))
    frames.append(lt.drop_recurring(spark.createDataFrame([(1, "a b c d e f g h i j k l m n", "en", "s", 1)], DOCS)))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows its code only when it has run
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        for df in frames:
            df.select("*").explain("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert len(sizes) > 20 and max(sizes) <= 8000


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    frame, counts = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, FOLDER)
        assert frame.columns == docs.columns
        frame = spark.createDataFrame(frame.collect(), docs.schema)
        counts.append(frame.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.8 * counts[0]
    last = corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).collect()
    texts = {r.doc_id: r.text for r in frame.collect()}
    assert {r.doc_id for r in last} == set(texts)
    check_packing(last, texts)
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).select("doc_id", "start", "ids_crc32").collect())) == sorted(
        f"Row(doc_id={r.doc_id}, start={r.start}, ids_crc32={r.ids_crc32})" for r in last
    )


def test_stages_take_empty_and_odd_tables(spark):
    for docs in (empty_docs(spark), odd_docs(spark, "rank", "length")):
        frame = docs
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, FOLDER)
        assert frame.count() >= 0
