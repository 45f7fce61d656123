"""SQL functions against the columns they stand for, also with other rule tables."""

from pyspark.sql import functions as F

from threadloom.functions import sql
from threadloom.functions import tags as tg
from threadloom.functions import text as tx
from threadloom.operators import classify

TEXTS = ["", None, "why? it's \"wrong\"", "Dr. x, professor", "ſyſtem ıs", "a\nb\\c", "<a href='x'><b>t</b> <pre><code>\n1</code></pre>",
         "<c#><a>", "|x||y|", "I'm a developer & phd", "<IMG\nsrc=1>", "no vowels: bcd fgh", "éa İ ß!.. ok?"]


def test_same_as_columns(spark):
    names = sql.register(spark, "t_")
    assert len(names) == len(set(names)) == 13
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, s string")
    c, text = F.col("s"), F.coalesce("s", F.lit(""))
    wanted = {
        "comment_class(s)": classify.comment_class(c), "user_degree(s)": classify.degree(c), "user_type(s, s)": classify.user_type(c, c),
        "words(s)": tx.tokenize(text), "sentence_count(s)": tx.sentence_count(text), "syllable_count(s)": tx.syllable_count(tx.tokenize(text)),
        "link_count(s)": tx.link_count(text), "has_image(s)": tx.has_image(text), "code_blocks(s)": tx.code_blocks(text),
        "strip_tags(s)": tx.strip_tags(text), "tag_list(s)": tg.tags_to_list(c)}
    got = df.selectExpr("i", *[f"t_{call} AS `{call}`" for call in wanted]).orderBy("i").collect()
    assert got == df.select("i", *[w.alias(call) for call, w in wanted.items()]).orderBy("i").collect()
    ease = spark.sql("SELECT t_reading_ease(0, 1, 0), t_reading_ease(10, 2, 15), t_reading_ease(NULL, 1, 1)").first()
    assert list(ease) == [0.0, 206.835 - 1.015 * 5 - 84.6 * 1.5, 0.0]


def test_other_rules_and_quotes(spark):
    sql.register(spark, "u_", comment_rules=[("it's", ["o'clock", r"back\\slash"])], comment_default="none", degree_rules=[("X", ["x"])],
                 academic=["a'b"], practical=["c\\d"])
    row = spark.sql(r"""SELECT u_comment_class("five O'Clock"), u_comment_class('back\\slash'), u_comment_class('x'), u_user_degree('an x.'),
                     u_user_type("a'b", NULL), u_user_type('c\\d', '')""").first()
    assert list(row) == ["it's", "it's", "none", "X", "Academic", "Practical Developer"]
