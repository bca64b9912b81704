"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them
(built-in functions only)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import BLANKS, settle

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_capitals", "n_shouts", "n_symbol_words", "n_plain_words")

# Words that hold a symbol, and words of letters with at most one sign behind them. Possessive, so that a word
# is read once however long it is.
_SYMBOL_WORD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D#*$%&|<>]*+[#*$%&|<>]"
_PLAIN_WORD = r"(?<![^\x20\x09-\x0D])\p{L}++[.,;:?]?+(?![^\x20\x09-\x0D])"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for all its uses."""
    return F.transform(F.array(value), body)[0]


# A window is packed into one long: the upper bits of its hash, then its position.
_PLACE = 24
_MOST = 1 << _PLACE


def _packed(w: Column) -> Column:
    """The 3-word windows of a text as longs, sorted: windows with equal hash bits are neighbours."""
    hashed = lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
    return F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.shiftleft(hashed(x, i), _PLACE).bitwiseOR(i.cast("long")),
    )


def _doubled(rows: Column, key) -> Column:
    """The entries of the sorted array ``rows`` whose key a neighbour has too."""
    same = lambda x, y: F.coalesce(key(x) == key(y), F.lit(False))
    return F.filter(rows, lambda x, i: same(x, F.get(rows, i + 1)) | same(x, F.get(rows, i - 1)))


def _covered(at: Column) -> Column:
    """How many words the windows at the sorted positions ``at`` cover: each three, less what the next
    one covers too."""
    steps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, v: a + v)


def _repeated(words: Column, packed: Column) -> Column:
    """How many words lie in a 3-word window that occurs at least twice.

    Windows with equal hash bits are candidates; only they are compared word by word, and that decides.
    Texts too long for a packed position have all windows compared.
    """
    place = lambda x: x.bitwiseAND(F.lit(_MOST - 1)).cast("int")
    window = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    hits = F.when(
        F.size(words) < _MOST,
        F.transform(_let(packed, lambda s: _doubled(s, lambda x: F.shiftright(x, _PLACE))), place),
    ).otherwise(F.sequence(F.lit(0), F.size(words) - 3))
    compared = lambda at: F.sort_array(F.transform(at, lambda i: F.struct(window(i).alias("k"), i.alias("i"))))
    equal = lambda at: _let(compared(at), lambda rows: _doubled(rows, lambda x: x["k"]))
    count = lambda at: _let(F.sort_array(F.transform(equal(at), lambda x: x["i"])), _covered)
    return _let(hits, lambda at: F.when(F.size(at) == 0, F.lit(0).cast("long")).otherwise(count(at)))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the metrics of every whole text added (columns of the same names are replaced)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, BLANKS), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    split = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"), F.char_length(F.array_join(w, "")).cast("long").alias("chars"),
            w.alias("words"), F.sort_array(_packed(w)).alias("packed"),
        ),
    )
    cut = _let(lines, lambda a: F.struct(F.size(a).alias("n"), F.size(F.array_distinct(a)).alias("distinct")))
    less = lambda pattern: F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))
    measured = _let(
        split,
        lambda x: F.struct(
            x["n"].alias("n_words"), x["chars"].alias("word_chars"), _repeated(x["words"], x["packed"]).alias("n_repeat_words")
        ),
    )
    return docs.withColumns({"_words": measured, "_lines": cut}).withColumns({
        "n_words": F.col("_words.n_words"),
        "word_chars": F.col("_words.word_chars"),
        "n_symbols": less("[#*$%&|<>]+").cast("long"),
        "n_dup_lines": (F.col("_lines.n") - F.col("_lines.distinct")).cast("long"),
        "n_repeat_words": F.col("_words.n_repeat_words"),
        "n_lines": F.col("_lines.n").cast("long"),
        "n_capitals": less(r"\p{Lu}+").cast("long"),
        "n_shouts": (F.char_length(text) - F.char_length(F.replace(text, F.lit("!"), F.lit("")))).cast("long"),
        "n_symbol_words": F.regexp_count(text, F.lit(_SYMBOL_WORD)).cast("long"),
        "n_plain_words": F.regexp_count(text, F.lit(_PLAIN_WORD)).cast("long"),
    }).drop("_words", "_lines")


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, good where ``good`` holds, and abstains in between."""

    name: str
    good: str
    bad: str


# Thresholds in whole numbers, so that every engine decides alike. Each kind of junk is seen by two rules or
# more, so that their agreement tells it from a rule's own mistakes.
RULES = (
    Rule("symbols", "50 * n_symbols <= n_words", "4 * n_symbols >= n_words"),
    Rule("symbol_words", "50 * n_symbol_words <= n_words", "5 * n_symbol_words >= n_words"),
    Rule("plain_words", "5 * n_plain_words >= 4 * n_words", "5 * n_plain_words <= 3 * n_words"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 9 * n_words", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    Rule("duplicate_lines", "n_dup_lines = 0", "2 * n_dup_lines >= n_lines"),
    Rule("repetition", "10 * n_repeat_words <= n_words", "2 * n_repeat_words > n_words"),
    Rule("capitals", "5 * n_capitals <= word_chars", "2 * n_capitals >= word_chars"),
    Rule("shouting", "20 * n_shouts <= n_words", "5 * n_shouts >= n_words"),
)
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"

# A vote is -1 (bad), 0 (abstains) or 1 (good); a model has its chance in either class.
VOTES = (-1, 0, 1)


@dataclass(frozen=True)
class Model:
    """``chances[j][vote]``: of rule j's vote in the good and in the bad class."""

    prior: float
    chances: tuple[dict[int, tuple[float, float]], ...]

    def weight(self, rule: int, vote: int) -> float:
        good, bad = self.chances[rule][vote]
        return math.log(good / bad)

    def log_odds(self, votes: tuple[int, ...]) -> float:
        """Of good quality."""
        return math.log(self.prior / (1 - self.prior)) + sum(self.weight(j, v) for j, v in enumerate(votes))

    def column(self, names: list[str]) -> Column:
        """The same as an expression over vote columns."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for j, name in enumerate(names):
            by_vote = F.lit(self.weight(j, 0))
            for v in (-1, 1):
                by_vote = F.when(F.col(name) == v, F.lit(self.weight(j, v))).otherwise(by_vote)
            total = total + by_vote
        return total


Patterns = list[tuple[tuple[int, ...], int]]

# Where every fit begins: the share of good rows, and the chances of a vote in the good and in the bad class,
# the same for all rules. They stay in the fit as this many rows, however large the table is.
PRIOR, HELD = 0.8, 10.0
# How often a rule may be taken to vote bad on good rows. Junk of a kind that only one rule sees would else be
# explained as that rule's mistakes as soon as another kind is more common.
ERRS = 0.01
FIRST = {-1: (0.001, 0.2), 0: (0.1, 0.1), 1: (0.899, 0.7)}


def start(rules: tuple[Rule, ...]) -> Model:
    """Where the fit begins: a bad vote of any rule is taken to be right, and the votes seen settle how far it is."""
    return Model(PRIOR, (FIRST,) * len(rules))


def _dealt(patterns: Patterns, model: Model, rules: tuple[Rule, ...]) -> tuple[float, list[dict[int, list[float]]]]:
    """Rows of the good class, and votes of each rule by class, if ``model`` deals the rows to the classes."""
    good, seen = 0.0, [{v: [0.0, 0.0] for v in VOTES} for _ in rules]
    for votes, n in patterns:
        p = 1 / (1 + math.exp(-max(-700.0, min(700.0, model.log_odds(votes)))))
        good += n * p
        for j, v in enumerate(votes):
            seen[j][v][0] += n * p
            seen[j][v][1] += n * (1 - p)
    return good, seen


def fit(patterns: Patterns, rules: tuple[Rule, ...], rounds: int = 200) -> Model:
    """Expectation-maximisation over vote patterns with counts: how often each rule votes bad, abstains
    or votes good in either class, and how common the good class is.

    All chances move freely from a start that is the same for every rule; it stays as pseudo-counts of HELD
    rows, which keep rare votes finite. A bad vote that others confirm comes to weigh heavily, one that
    mostly stands alone comes to weigh little, and so do abstentions. Three bounds settle which class is the
    good one: it is at least half, a rule votes bad on at most ERRS of it, and in the bad class a rule
    abstains no more often than in the good one or than it votes bad there. Without the last, rules that
    abstain on the same rows would make a class of their own in a corpus without junk.
    """
    model, rows = start(rules), sum(n for _, n in patterns)
    for _ in range(rounds):
        good, seen = _dealt(patterns, model, rules)
        prior = max(0.5, (good + HELD * PRIOR) / (rows + HELD))
        chances = []
        for by_vote in seen:
            total = {v: [by_vote[v][c] + HELD * FIRST[v][c] * (PRIOR, 1 - PRIOR)[c] for c in (0, 1)] for v in VOTES}
            good_part, bad_part = [{v: total[v][c] / sum(total[w][c] for w in VOTES) for v in VOTES} for c in (0, 1)]
            wrong = min(good_part[-1], ERRS)
            good_part = {-1: wrong, 0: good_part[0], 1: good_part[1] + good_part[-1] - wrong}
            silent = min(bad_part[0], max(good_part[0], bad_part[-1]))
            bad_part = {-1: bad_part[-1], 0: silent, 1: bad_part[1] + bad_part[0] - silent}
            chances.append({v: (good_part[v], bad_part[v]) for v in VOTES})
        moved = max(abs(prior - model.prior), *(abs(a[v][c] - b[v][c]) for a, b in zip(chances, model.chances) for v in VOTES for c in (0, 1)))
        model = Model(prior, tuple(chances))
        if moved < 1e-9:
            break
    return model


def judge(docs: DataFrame, *, text_col: str = "text", rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """``docs`` with metrics, ``base_failed``, ``posterior`` and ``kept``.

    The rules' votes are counted by pattern over all rows (at most 3 to the number of rules patterns,
    whatever the number of rows); expectation-maximisation runs on those counts. A row stays if it
    passes the base rule and its posterior reaches ``threshold``.

    A null text counts as empty; empty texts have no words and fail the base rule; rows are judged one
    by one, so repeated rows and null or repeated ids change nothing; an empty table gives an empty
    result. Columns with the names of the results are replaced, all others stay as they are.
    """
    measured = measures(docs, text_col)
    names = [f"_vote_{j}" for j in range(len(rules))]
    votes = measured.withColumns({
        n: F.expr(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END") for n, r in zip(names, rules)
    })
    votes = settle(votes, "quality-votes")
    counted = votes.where("n_words > 0").groupBy(*names).count().collect()
    # Sorted, so that the sums do not depend on the order in which counts arrive.
    model = fit(sorted((tuple(r[n] for n in names), r["count"]) for r in counted), rules)
    odds = model.column(names)
    return votes.withColumns({
        "base_failed": F.expr(BASE_FAILED),
        "posterior": F.lit(1.0) / (F.exp(-odds) + 1),
    }).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)).drop(*names)


def good_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns only."""
    own = docs.columns
    # Own columns travel under other names: a column named like a result must come out untouched.
    safe = [f"_own_{i}" for i in range(len(own))]
    renamed = docs.toDF(*safe)
    text = safe[own.index(options.pop("text_col", "text"))]
    kept = judge(renamed, text_col=text, **options).where("kept")
    return kept.select(*[F.col(s).alias(c) for s, c in zip(safe, own)])
