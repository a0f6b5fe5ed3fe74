"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are
its context and only that reply is trainable.  Turns after the last
assistant turn (or all turns, when there is none) make one more example
without a trainable span, so a conversation is always whole in its last
example.

Template of a turn: ``<|turn|>`` role ``<|text|>`` text ``<|end|>``.
Control strings inside roles and texts are escaped reversibly: a backslash is
doubled, and a backslash is put behind the first character of every control
string, so no control string is left in escaped text; ``unescape`` drops the
backslash of every pair (backslash, character).

All work is DataFrame functions: one shuffle by conversation, then array
functions.  The formatted text of a conversation is written once for every
assistant turn, as the method asks; the work therefore grows with turns
squared inside one conversation, never across conversations.

Defined cases: null text and null role are empty; turns are ordered by
(turn, role, text), nulls first, so ties and repeated rows have a fixed
order and are all kept; a null conversation id is one conversation; an empty
table gives no examples.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings that must not survive inside a role or text.
CONTROL = ("<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def format_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """Examples ``(conv_id, example, formatted, loss_start, loss_end)``.

    ``loss_start``/``loss_end`` are code-point offsets (from 0, end
    exclusive) of the trainable reply, escaped as it stands in ``formatted``;
    both are null in the example that holds trailing turns.
    """
    turns = (df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                       F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
               .withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)))
               .withColumn("body", escape(F.col("text"))))
    convs = (turns.groupBy("conv_id")
                  .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "head", "body"))).alias("t"))
                  .withColumn("n", F.size("t"))
                  .withColumn("parts", F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(END)))))
    ends = F.filter(F.sequence(F.lit(1), F.col("n")),
                    lambda i: (i == F.col("n")) | (F.element_at("t", i)["role"] == "assistant"))
    ex = convs.select("conv_id", "t", "parts", F.posexplode(ends).alias("example", "last"))
    target = F.element_at("t", F.col("last"))
    trains = target["role"] == "assistant"
    context = F.array_join(F.slice("parts", F.lit(1), F.col("last") - 1), "")
    ex = (ex.withColumn("context", context)
            .withColumn("loss_start", F.when(trains, F.length("context") + F.length(target["head"])))
            .withColumn("loss_end", F.col("loss_start") + F.length(target["body"]))
            .withColumn("formatted", F.concat("context", F.element_at("parts", F.col("last")))))
    return ex.select("conv_id", F.col("example").cast("long").alias("example"), "formatted",
                     F.col("loss_start").cast("long").alias("loss_start"),
                     F.col("loss_end").cast("long").alias("loss_end"))


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of each conversation, parsed from the formatted examples only.

    The last example of a conversation holds all its turns; the loss text is
    cut out of every example by its span and unescaped.
    """
    loss = unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1,
                                (F.col("loss_end") - F.col("loss_start")).cast("int")))
    per = examples.select("conv_id", "example", "formatted",
                          F.when(F.col("loss_start").isNotNull(), loss).alias("loss"))
    got = (per.groupBy("conv_id")
              .agg(F.max(F.struct("example", "formatted"))["formatted"].alias("whole"),
                   F.sum(F.length("formatted")).alias("formatted_chars"),
                   F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses")))
    chunks = F.slice(F.split(F.col("whole"), r"\Q<|turn|>\E"), 2, 1 << 30)
    turns = F.transform(chunks, lambda c: F.split(F.left(c, F.length(c) - len(END)), r"\Q<|text|>\E"))
    all_turns = F.array_join(F.transform(turns, lambda x: F.concat(unescape(x[0]), F.lit("\n"), unescape(x[1]),
                                                                   F.lit("\n"))), "")
    all_loss = F.array_join(F.transform("losses", lambda x: F.coalesce(x["loss"], F.lit(""))), "")
    return got.select("conv_id", F.size(turns).cast("long").alias("n_turns"),
                      F.sha2(all_turns.cast("binary"), 256).alias("turns_sha256"),
                      F.length(all_loss).cast("long").alias("loss_chars"),
                      F.sha2(all_loss.cast("binary"), 256).alias("loss_sha256"),
                      F.col("formatted_chars").cast("long").alias("formatted_chars"))
