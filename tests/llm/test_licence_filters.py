"""What the licence scan leaves out before it compares: nothing that can count."""

from pyspark.sql import functions as F

from floodmark.llm import licences

LINES = [
    "Licensed under the MIT license.",
    "LICENSED\tUNDER the mit-LICENSE",
    "relicensed mitten copyrights licensed2 gpl+ 3gpl",
    "(GPL)",
    "aKernel of ſoftware, İSC fee?",
    "noéfee café feeé",
    "",
    "... ---",
    "under cc by",
    "general  --  public",
]


def test_words_and_pairs_are_found_as_by_splitting(spark):
    line = F.col("line")
    rows = spark.createDataFrame([(x,) for x in LINES], "line string")
    told, pairs = licences.telling_words(), licences.key_pairs(licences.SHARE)
    among = lambda found, of: F.arrays_overlap(found, F.array(*map(F.lit, of)))
    found = rows.select(
        line,
        licences.has_word(line, told).alias("word"),
        among(licences.words(line), told).alias("word_wanted"),
        licences.may_have_pair(line, pairs).alias("pair"),
        F.coalesce(among(licences.pairs(licences.words(line)), pairs), F.lit(False)).alias("pair_wanted"),
    ).collect()
    assert [(r["word"], r["pair"]) for r in found] == [(r["word_wanted"], r["pair_wanted"]) for r in found]
    assert {r["word"] for r in found} == {r["pair"] for r in found} == {True, False}


def test_no_share_of_a_notice_is_without_key_pairs():
    telling = set(licences.telling_words())
    for share in (0.01, 0.5, 0.6, 1.0):
        keys = set(licences.key_pairs(share))
        for _, notice in licences.NOTICES:
            wanted = {p for p in licences._pairs(notice) if licences._telling(p, telling)}
            assert len(wanted - keys) / len(wanted) < share
    assert licences.key_pairs(0.0) is None and licences.key_pairs(1.1) == []


def test_notices_wrapped_anywhere_pass_in_their_documents(spark):
    texts = []
    for _, notice in licences.NOTICES:
        found = notice.split(" ")
        for mark in ("", "# ", "dnl ", "REM\t", " * "):
            texts += [("\n" + mark).join(found), mark + " ".join(found[:3]) + "\r\n" + mark + " ".join(found[3:])]
    rows = spark.createDataFrame([(x,) for x in texts], "text string")
    kept = licences.may_have_pair(F.col("text"), licences.key_pairs(licences.SHARE), licences.ACROSS)
    assert rows.filter(~kept).count() == 0


def test_documents_without_key_pairs_are_never_split(spark, monkeypatch):
    """Texts whose lines hold telling words but no key pair do not reach the comparison."""
    split = []
    monkeypatch.setattr(licences, "written", lambda rows, name: split.append(rows) or rows)
    docs = spark.createDataFrame([(1, "free\nform of\nwork"), (2, "general\npublic\nlicense")], "doc_id long, text string")
    licences.wrapped(docs, licences.SHARE, "doc_id", "text")
    plan = split[0]._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Generate") :]
    assert "RLIKE" in below
