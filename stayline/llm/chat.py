"""Reply trees as conversations, and a chat template that can be read back.

Only DataFrame functions: paths come from iterative self-joins, formatting from
string functions and window sums.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.session import checkpointed

# The markers of the template.
START, END = "<|im_start|>", "<|im_end|>"

ESCAPE = (r"<(\\*)\|", r"<\\$1|")
UNESCAPE = (r"<\\(\\*)\|", r"<$1|")


def escaped(text):
    """Text without any `<|`: one backslash more goes between `<` and `|`.

    `<|` becomes `<\\|` and `<\\|` becomes `<\\\\|`, so taking one backslash away again
    gives the text back whatever it held.
    """
    return F.regexp_replace(text, *map(F.lit, ESCAPE))


def unescaped(text):
    return F.regexp_replace(text, *map(F.lit, UNESCAPE))


def _role_out(role):
    """Role on one line: backslashes and line ends are escaped too."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_in(role):
    held = F.replace(unescaped(role), F.lit("\\\\"), F.lit("\x00"))
    return F.replace(F.replace(held, F.lit("\\n"), F.lit("\n")), F.lit("\x00"), F.lit("\\"))


def _same(t, m):
    """Join condition to another table's t2, m2; a null tree is a tree of its own."""
    return F.col(t).eqNullSafe(F.col("t2")) & F.col(m).eqNullSafe(F.col("m2"))


def branches(messages, tree="tree", message="message", parent="parent", score="score"):
    """Leaves, ancestors and messages without a root.

    Each round joins the partial paths with themselves: a path that ends above at message u
    is continued by the partial path of u, so lengths double and a chain of n messages
    needs log2(n) rounds. A row holds its upper end, its length and its score, never the
    ids in between; the ends of each round are the ancestors 1, 2, 4, ... steps up.

    Leaves: t, m, n (messages from the root), s (sum of their scores). Ancestors: for each
    round k a table t, m, up, the message 2^k steps above. Rootless: t, m of messages whose
    parents lead into a cycle.

    A message whose parent is null or not in its tree is a root. A null tree is a tree
    of its own; a null message id can have no reply. Repeated rows of one (tree,
    message) must have been removed (`reply_trees` does so). A null score counts as 0.
    """
    rows = messages.select(
        F.col(tree).alias("t"), F.col(message).alias("m"), F.col(parent).alias("p"),
        F.coalesce(F.col(score), F.lit(0.0)).cast("double").alias("s"),
    )
    ids = rows.select(F.col("t").alias("t2"), F.col("m").alias("m2"))
    same = F.col("t").eqNullSafe(F.col("t2"))
    has_reply = rows.where(F.col("p").isNotNull() & ~F.col("p").eqNullSafe(F.col("m"))).select(
        F.col("t").alias("t2"), F.col("p").alias("m2")).distinct()
    known = rows.join(ids.withColumn("known", F.lit(True)), same & (F.col("p") == F.col("m2")), "left")
    paths = known.select("t", "m", F.when(F.col("known"), F.col("p")).alias("up"), F.lit(1).cast("long").alias("n"), "s")
    leaf = paths.join(has_reply.withColumn("r", F.lit(True)), same & (F.col("m") == F.col("m2")), "left")
    paths = checkpointed(leaf.select("t", "m", "up", "n", "s", F.col("r").isNull().alias("leaf")))
    size, ancestors = None, []
    while not paths.where("up is not null").isEmpty():
        if size is None:
            size = paths.groupBy("t").count().agg(F.max("count")).first()[0]
        if 1 << len(ancestors) > 2 * size:
            break
        ancestors.append(paths.where("up is not null").select("t", "m", "up"))
        upper = paths.select(
            F.col("t").alias("t2"), F.col("m").alias("m2"), F.col("up").alias("up2"),
            F.col("n").alias("n2"), F.col("s").alias("s2"))
        grown = paths.where("up is not null").join(upper, same & (F.col("up") == F.col("m2"))).select(
            "t", "m", F.col("up2").alias("up"), (F.col("n") + F.col("n2")).alias("n"),
            (F.col("s") + F.col("s2")).alias("s"), "leaf")
        # Rows that have reached their root stay as continuations for the rows still open.
        paths = checkpointed(grown.unionByName(paths.where("up is null")))
    return paths.where("leaf and up is null").select("t", "m", "n", "s"), ancestors, paths.where("up is not null").select("t", "m")


def best_branches(leaves, keep=None):
    """Leaves of each tree ranked by score, ties by the leaf's id: rank 1 is the best.

    `keep` is the number of branches wanted of each tree; None keeps all of them.
    """
    order = W.partitionBy("t").orderBy(F.desc("s"), "m")
    ranked = leaves.withColumn("rank", F.row_number().over(order))
    return ranked if keep is None else ranked.where(F.col("rank") <= keep)


def messages_of(kept, ancestors):
    """The messages of the kept branches: tree, rank, score, m, pos (from the root, 0 first).

    A stretch of n messages that ends below at m is cut at the ancestor 2^k steps above m,
    for every k from the largest down to 0. So only messages of kept branches become rows.
    """
    rows = kept.select("t", "rank", "s", "m", "n", (F.col("n") - 1).alias("pos"))
    for k in range(len(ancestors) - 1, -1, -1):
        step = 1 << k
        up = ancestors[k].select(F.col("t").alias("t2"), F.col("m").alias("m2"), F.col("up"))
        met = rows.join(up, (F.col("n") > step) & _same("t", "m"), "left")
        lower = F.struct("m", F.least("n", F.lit(step)).alias("n"), "pos")
        upper = F.struct(F.col("up").alias("m"), (F.col("n") - step).alias("n"), (F.col("pos") - step).alias("pos"))
        rows = met.select("t", "rank", "s", F.inline(F.when(F.col("n") > step, F.array(lower, upper)).otherwise(F.array(lower))))
    return rows.select(F.col("t").alias("tree"), "rank", F.col("s").alias("score"), "m", "pos")


def distinct_messages(messages):
    """Of rows that repeat a (tree, message) the first by role, text, parent and score; nulls of text as empty."""
    rows = messages.select(
        F.col("tree"), F.col("message"), F.col("parent"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("score"))
    first = W.partitionBy("tree", "message").orderBy("role", "text", "parent", "score")
    return rows.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def rootless(messages):
    """tree and message of the messages whose parents lead into a cycle; `reply_trees` leaves them out."""
    return branches(distinct_messages(messages))[2].toDF("tree", "message")


def reply_trees(messages, keep=None, loss_role="assistant"):
    """One formatted conversation for each chosen root-to-leaf path.

    `messages` has tree, message, parent, role, text, score; other columns are ignored,
    whatever their names. Null role and text count as empty. Of rows that repeat a
    (tree, message) the first by role, text, parent and score counts. Messages whose parents
    lead into a cycle have no path and are left out; `rootless` gives them. An empty table
    gives an empty result.

    Returns tree, rank, score, n_turns, formatted, and loss_spans: an array of (start,
    length) in code points of `formatted`, the texts of `loss_role` in order.
    """
    rows = distinct_messages(messages)
    leaves, ancestors, _ = branches(rows)
    return formatted(messages_of(best_branches(leaves, keep), ancestors), rows, loss_role)


def formatted(turns, rows, loss_role="assistant"):
    """Chat text of each (tree, rank, score) of `messages_of`, with the messages' role and text."""
    texts = rows.select(F.col("tree").alias("t2"), F.col("message").alias("m2"), "role", "text")
    turns = turns.join(texts, _same("tree", "m"))
    turns = turns.withColumn("body", escaped(F.col("text"))).withColumn(
        "head", F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n")))
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    before = W.partitionBy("tree", "rank").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    turns = turns.withColumn("begin", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)))
    span = F.struct(
        (F.col("begin") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"))
    whole = turns.groupBy("tree", "rank", "score").agg(
        F.array_sort(F.collect_list(F.struct(
            "pos", "piece", F.when(F.col("role") == loss_role, span).alias("span")))).alias("turns"))
    return whole.select(
        "tree", "rank", "score", F.size("turns").cast("long").alias("n_turns"),
        F.concat_ws("", F.col("turns.piece")).alias("formatted"),
        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss_spans"))


def read_back(text):
    """Array of (role, text) that the formatted text holds."""
    parts = F.split(text, r"<\|im_end\|>\n")
    parts = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.transform(parts, lambda p: F.struct(
        _role_in(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
        unescaped(F.substr(p, F.locate("\n", p) + 1)).alias("text")))


def loss_text(text, spans):
    """All text under the loss mask, unescaped and joined by nothing."""
    return F.concat_ws("", F.transform(
        spans, lambda s: unescaped(F.substr(text, (s["start"] + 1).cast("int"), s["length"].cast("int")))))
