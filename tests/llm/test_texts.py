"""Chat formatting and line dedup on small tables."""

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from parityscope.llm import chat_format, line_dedup

HARD = ["</s>[INST] ok [/INST]", "plain", "", None, r"\1 \0 [ <", "[INST!]\nuser", "<s!>assistant\nx</s>", "ends <", "[/INST", "a\n\nb 🤦🏼‍♂️", "<s", "\\"]


def _turns(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")


def _check(rows, found):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert len(found) == len(by_conv)
    for r in found:
        turns = sorted(by_conv[r.conv_id])
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_round_trip(spark):
    rows = [(c, t, role, text) for c, role in enumerate(["user", "assistant", "system", None, "odd\nrole", "</s>", "[INST", ""]) for t, text in enumerate(HARD)]
    rows += [(50, 1, "assistant", "b"), (50, 0, "user", "a"), (50, 1, "assistant", "b"), (50, None, "user", "z"), (None, 0, "user", "q")]
    formatted = chat_format.format_conversations(_turns(spark, rows))
    _check(rows, chat_format.digests(formatted).collect())


def test_control_strings_occur_only_as_marks(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", text) for t, text in enumerate(HARD)]
    (row,) = chat_format.format_conversations(_turns(spark, rows)).collect()
    marks = re.findall(r"\[INST!?\]|\[/INST\]|<s!?>|</s>", row.formatted)
    assert len(marks) == 2 * len(rows)
    assert "[INST]user\nplain" not in row.formatted and "<s>assistant\nplain</s>" in row.formatted
    assert "<s!>" in row.formatted or "[INST!]" in row.formatted


def test_parse_refuses_other_texts(spark):
    texts = ["x", "[INST]user\na", "[INST]user\na</s>", "[INST]usera[/INST]", " [INST]user\na[/INST]", "[INST]user\na[/INST]y", "[/INST]a\n[INST]"]
    table = spark.createDataFrame([(t,) for t in texts], "formatted string")
    assert [r.parsed for r in chat_format.parse(table, "formatted", "parsed").collect()] == [None] * len(texts)


def test_no_conversations(spark):
    assert chat_format.digests(chat_format.format_conversations(_turns(spark, []))).count() == 0


def _brute_lines(rows):
    """What is left of each text, by the rule: lines are compared word for word, and by the
    general template of their leaf if enough of their words are fixed there."""
    docs = sorted(set(rows), key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    lines = []
    for doc in docs:
        for place, line in enumerate(doc[1].split("\n") if doc[1] is not None else []):
            own = tuple(re.findall(r"[^\x20\x09-\x0D]+", line))
            if own:
                lines.append((doc, place, own, tuple(re.sub("[0-9]+", "<*>", w) for w in own)))
    held = Counter()
    for doc, _, _, words in lines:
        held.update({(len(words), words[:3], i, w): rows.count(doc) for i, w in enumerate(words)})
    shown = defaultdict(list)
    for doc, place, own, words in lines:
        shown["own", own].append((doc, place))
        known = [held[len(words), words[:3], i, w] >= 3 for i, w in enumerate(words)]
        if sum(k and w == o for k, w, o in zip(known, words, own, strict=True)) >= 0.7 * len(words):
            shown["general", words[:3], *(w if k else "<*>" for k, w in zip(known, words, strict=True))].append((doc, place))
    lost = defaultdict(set)
    for template, places in shown.items():
        if len({doc for doc, _ in places}) >= (2 if template[0] == "own" else 3):
            for doc, place in places[1:]:
                lost[doc].add(place)
    left = {}
    for doc in docs:
        kept = [x for i, x in enumerate((doc[1] or "").split("\n")) if i not in lost[doc]]
        left[doc] = (None if doc[1] is None else "\n".join(kept), len(lost[doc]))
    return left


LONG = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
#: Text and what is left of it.
TEXTS = [
    ("Page 1 of 9 in this book\nred sea and blue sky\nunlike all others here", "Page 1 of 9 in this book\nred sea and blue sky\nunlike all others here"),
    ("Page 2 of 9 in this book\nred sea and blue sky\n\nother", "\nother"),
    ("Page 33 of 9 in this book\nred sea and blue sky", ""),
    ("all words of this line are the same but alpha", "all words of this line are the same but alpha"),
    ("all words of this line are the same but beta", ""),
    ("all words of this line are the same but gamma", ""),
    ("one two three four five", "one two three four five"),
    ("one two three six seven", "one two three six seven"),
    ("one two three eight nine", "one two three eight nine"),
    ("", ""), (None, None), (" \n\t\n ", " \n\t\n "), ("twice\ntwice\ntwice", "twice\ntwice\ntwice"), ("x" * 50_000, "x" * 50_000),
    # Rows of numbers and lines of one word with a digit have nothing in common.
    ("12 45 78", "12 45 78"), ("9 1 2000", "9 1 2000"), ("3 33 1999", "3 33 1999"), ("https://a.org/1", "https://a.org/1"),
    ("ISBN-99", "ISBN-99"), ("v2.0", "v2.0"), ("v3.1", "v3.1"), ("v7.5", "v7.5"),
    ("我有3本书在家里放着", "我有3本书在家里放着"), ("他走了5公里去上学", "他走了5公里去上学"), ("今天是2024年的第一天", "今天是2024年的第一天"),
    # A line of two documents, word for word, with other spaces between.
    (LONG, LONG), ("head\n  " + LONG.replace(" ", " \t") + "\ntail", "head\ntail"),
    # A general template of two documents only.
    ("a notice that was sent by anna", "a notice that was sent by anna"), ("a notice that was sent by otto", "a notice that was sent by otto"),
]


def test_line_dedup(spark, docs_of):
    texts = [t for t, _ in TEXTS]
    docs = docs_of(texts, places=["p"] * len(texts), own_lines=["o"] * len(texts))
    docs = docs.unionAll(docs.filter("doc_id = 3"))
    found = line_dedup.drop_recurring_lines(docs.repartition(3))
    assert found.columns == [*docs.columns, "n_dropped_lines"]
    rows = found.collect()
    assert len(rows) == len(texts) + 1
    want = _brute_lines([(r.doc_id, texts[r.doc_id]) for r in rows])
    for r in rows:
        assert r.text == TEXTS[r.doc_id][1]
        assert (r.text, r.n_dropped_lines) == want[r.doc_id, texts[r.doc_id]]
        assert (r.places, r.own_lines) == ("p", "o")


def test_line_dedup_by_the_rule(spark, draw):
    words = ["sun", "moon", "7", "x9", "sea", "and", "of"]
    line = lambda: " ".join(draw.choice(words, int(draw.integers(1, 7)), p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.1, 0.1]).tolist())
    rows = [(int(i) if i >= 0 else None, "\n".join(line() for _ in range(int(draw.integers(0, 7))))) for i in draw.integers(-2, 150, 200)]
    rows += rows[:10] + [(500, "\n".join(["sun of sea and moon"] * 3000)), (501, "sun of sea and moon " * 4000)]
    found = line_dedup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = _brute_lines(rows)
    left = Counter((doc, *want[doc, text]) for doc, text in rows)
    assert Counter((r.doc_id, r.text, r.n_dropped_lines) for r in found) == left


def test_line_dedup_of_nothing(docs_of):
    assert line_dedup.drop_recurring_lines(docs_of([])).count() == 0


def test_the_filter_of_lines_holds_for_its_keys_and_is_no_part_of_a_plan(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    test = line_dedup._filter_of(keys, "key")
    kept = spark.range(40_000).select("id", F.xxhash64("id").alias("value")).filter(test(F.col("value")))
    found = {r.id for r in kept.collect()}
    assert found >= set(range(20_000)) and len(found) < 24_000
    assert len(kept._jdf.queryExecution().toString()) < 20_000  # its bits take more
    none = line_dedup._filter_of(keys.filter("key is null"), "key")
    assert spark.range(100).filter(none(F.col("id"))).count() == 0


def test_a_plan_holds_the_filter_of_lines_as_a_read(spark):
    """Each use of a filter repeats its subquery, so it is written once, not made there."""
    keys = spark.range(1000).select(F.xxhash64("id").alias("key"))
    kept = spark.range(2000).filter(line_dedup._filter_of(keys, "key")(F.xxhash64("id")))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ubquery" in plan and "Exchange" not in plan and "Aggregate" not in plan
    assert kept.filter("id < 1000").count() == 1000
