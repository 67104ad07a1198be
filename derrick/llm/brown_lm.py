"""Brown class-based bigram model: perplexity from class transitions and emissions.

p(word | previous) = p(class | previous class) p(word | class). The ``VOCABULARY``
most frequent words are the core, dealt to ``CLASSES`` classes by exchange clustering:
a word moves to the class that raises the likelihood of the class bigrams most, until
none moves. Every further training word, however rare, joins the class under which all
its occurrences with their neighbours are likeliest, so the clustered vocabulary is the
corpus's. While that is found, neighbours outside the core count as one of ``RARE``
contexts by a hash of their last two characters; the model itself has no such classes.
Transitions are then counted anew over the classes of all words. They are smoothed by a
prior proportional to the class counts, emissions by an added half. Only words that
were never seen fall back to a class of their own: it has the share of tokens that are
words seen once (Good-Turing), dealt over as many words as those.

Base score: every token has log10((c + 1) / (N + V + 1)).

Scale: (1) words are counted per task and summed by a shuffle on the word, so every
distinct word is a row and no dictionary of the corpus exists; (2) bigrams of core
words and contexts are counted, at most (VOCABULARY + RARE + 2)^2 rows; (3) of every
other word the classes before and after are counted per task, meet by a shuffle on the
word and choose its class; (4) texts become strings of classes: the ``FREQUENT`` most
frequent words travel to the tasks, the places of the others meet their classes by a
shuffled join and come back to their document; (5) transitions and scores are read off
these strings. Documents are told apart by a key of id and text. The exchange runs on
the bounded bigram matrix.

Learning uses the documents whose crc32(doc_id as text) mod 7 is not 2. Edge cases:
null and empty texts are the end token alone; rows with a null id are learned from;
equal rows count as often as they occur and get equal rows; without training tokens
the base score is that of c = N = V = 0 and all classes are equally likely; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.llm.common import documents, row_key
from derrick.sources.scratch import materialize

VOCABULARY, CLASSES, RARE = 1_000, 48, 16
FREQUENT = 100_000
SWEEPS = 12
END = b"\x00"  # no word; stands for the end of a text
#: Distinct words a task gathers before it hands its counts on.
FLUSH = 300_000
#: Tokens whose neighbours a task gathers before it hands its counts on.
GATHER = 4_000_000
#: Documents whose rare words a task holds at a time.
CHUNK = 500
#: In a string of classes, a word whose class the task does not know.
OPEN = 255
PRIOR = 50.0
HALF = 0.5


def tokens(text: bytes | str | None) -> list[bytes]:
    """Lower-cased words: bytes know exactly the white space and letters meant."""
    if isinstance(text, str):
        text = text.encode("utf-8", "surrogatepass")
    return bytes(text).lower().split() if text else []


def _raw(texts: DataFrame) -> DataFrame:
    """The column ``text`` alone, as the bytes that tasks cut it in."""
    return texts.select(F.col("text").cast("binary").alias("text"))


def rare_class(word: bytes) -> int:
    return crc32(word[-4:].decode("utf-8", "ignore")[-2:].encode("utf-8", "surrogatepass")) % RARE


def held_out(doc_id: Column, mod: int = 7) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == 2, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over the column ``text``, the end token included."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for rows in batches:
            for t in rows["text"]:
                seen.update(tokens(t))
                seen[END] += 1
                if len(seen) > FLUSH:
                    yield pd.DataFrame({"word": list(seen), "c": list(seen.values())})
                    seen = Counter()
        yield pd.DataFrame({"word": list(seen), "c": list(seen.values())})

    counted = _raw(texts).mapInPandas(run, "word binary, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def bigram_counts(texts: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(a, b, c): how often a word of id ``a`` precedes one of id ``b``. Ids are the
    places in the vocabulary, then the rare classes, then the edge of a text."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)
    v = len(vocabulary)
    wide = v + RARE + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = _Ids(shared.value)
        seen = np.zeros(wide * wide, dtype=np.int64)
        for rows in (b.iloc[i : i + CHUNK] for b in batches for i in range(0, len(b), CHUNK)):
            flat: list[int] = []
            for t in rows["text"]:
                flat.append(wide - 1)
                flat += map(ids.__getitem__, tokens(t))
            flat.append(wide - 1)
            x = np.array(flat, dtype=np.int64)
            seen += np.bincount(x[:-1] * wide + x[1:], minlength=wide * wide)
        pair = np.flatnonzero(seen)
        yield pd.DataFrame({"pair": pair, "c": seen[pair]})

    counted = _raw(texts).mapInPandas(run, "pair long, c long")
    out = counted.groupBy("pair").agg(F.sum("c").alias("c"))
    return out.select((F.floor(F.col("pair") / wide)).cast("int").alias("a"), (F.col("pair") % wide).cast("int").alias("b"), "c")


class _Ids(dict):
    """Word -> id; unknown words have the id of their rare class."""

    def __init__(self, vocabulary: list[bytes]) -> None:
        super().__init__({w: i for i, w in enumerate(vocabulary)})
        self.first_rare = self.fixed = len(vocabulary)

    def __missing__(self, word: bytes) -> int:
        out = self.first_rare + rare_class(word)
        if len(self) < self.fixed + 200_000:
            self[word] = out
        return out


def exchange(counts: np.ndarray, movable: int, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of every id for the bigram ``counts``. The first ``movable`` ids are dealt
    to ``classes`` classes; each further id is a class of its own. The likelihood of
    the class bigrams is sum n log n over transitions minus the same over the class
    counts on either side; a move changes two rows and two columns."""
    n = len(counts)
    label = np.concatenate([np.arange(movable) % classes, classes + np.arange(n - movable)]).astype(int)
    k = classes + n - movable
    member = np.zeros((n, k))
    member[np.arange(n), label] = 1
    big = member.T @ counts @ member
    right, left = counts @ member, counts.T @ member  # of each id, by class

    def h(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)

    for _ in range(sweeps):
        moved = 0
        for w in range(movable):
            out, inn, loop, was = right[w], left[w], counts[w, w], label[w]
            if out.sum() + inn.sum() == 0:
                continue
            # The matrix without w, then with w in each class in turn.
            big[was] -= out
            big[:, was] -= inn
            big[was, was] += loop
            o, i = out.copy(), inn.copy()
            o[was] -= loop
            i[was] -= loop
            rows, cols = big.sum(axis=1), big.sum(axis=0)
            gain = (h(big + o) - h(big)).sum(axis=1)[:classes] + (h(big + i[:, None]) - h(big)).sum(axis=0)[:classes]
            own = np.diag(big)[:classes]
            gain += h(own + o[:classes] + i[:classes] + loop) - h(own + o[:classes]) - h(own + i[:classes]) + h(own)
            total_o, total_i = o.sum() + loop, i.sum() + loop
            gain -= (h(rows + total_o) - h(rows))[:classes] + (h(cols + total_i) - h(cols))[:classes]
            best = int(gain.argmax())
            if gain[best] <= gain[was] + 1e-9:
                best = was
            big[best] += o
            big[:, best] += i
            big[best, best] += loop
            if best != was:
                moved += 1
                label[w] = best
                for table, side in ((right, counts[:, w]), (left, counts[w])):
                    table[:, was] -= side
                    table[:, best] += side
        if not moved:
            break
    return label


def class_model(counts: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the smoothed transitions and the class counts. The last class is the
    edge of a text; it is followed by a first word and preceded by a last one."""
    k = int(label.max()) + 1
    big = np.zeros((k, k))
    np.add.at(big, (label[:, None], label[None, :]), counts)
    share = (big.sum(axis=0) + 1) / (big.sum() + k)
    moves = (big + PRIOR * share) / (big.sum(axis=1) + PRIOR)[:, None]
    return np.log10(moves), big.sum(axis=0)


def frequent_words(counts: DataFrame, most: int = FREQUENT) -> dict[bytes, int]:
    """The words above the lowest count at which at most ``most`` words are left. Words
    are first counted by sixteenths of a power of two, so nothing is sorted in one task."""
    words = counts.filter(F.col("word") != END)
    band = F.floor(16 * F.log2(F.col("c"))).cast("int")
    sizes = sorted(((r[0], r[1]) for r in words.groupBy(band).count().collect()), reverse=True)
    total, lowest = 0, None
    for b, size in sizes:
        if total + size > most:
            break
        total, lowest = total + size, b
    if lowest is None:
        return {}
    found = words.filter(band >= lowest).select("word", "c").toArrow().to_pydict()
    return dict(sorted(zip(found["word"], found["c"]), key=lambda x: (-x[1], x[0])))


class _Known(dict):
    """Word -> place; all other words have the place behind the last."""

    def __init__(self, words: list[bytes]) -> None:
        super().__init__((w, i) for i, w in enumerate(words))
        self.other = len(self)

    def __missing__(self, word: bytes) -> int:
        return self.other


class _Places(dict):
    """Word -> number; new words follow on the core and the edge of a text."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self) + 1
        return out


def neighbour_counts(texts: DataFrame, core: list[bytes], label: np.ndarray) -> DataFrame:
    """(word, seen) of the words outside the core, a row per word and round of a task:
    ``seen`` holds numbers count * 2W + c before the word, count * 2W + W + c after it,
    for the W contexts c of ``label`` (core classes, rare contexts, edge)."""
    shared = texts.sparkSession.sparkContext.broadcast((core, label))

    def rows_of(places: _Places, core: list[bytes], label: np.ndarray, flat: list[np.ndarray]) -> pd.DataFrame:
        v, wide = len(core), int(label[-1]) + 1
        new = list(places)[v:]
        context = np.concatenate([label[:v], label[-1:], label[v] + np.fromiter(map(rare_class, new), np.int64, len(new))])
        x = np.concatenate([*flat, [v]])
        at = np.flatnonzero(x > v)
        pair = x[at].astype(np.int64) * 2 * wide
        pair, c = np.unique(np.concatenate([pair + context[x[at - 1]], pair + wide + context[x[at + 1]]]), return_counts=True)
        word, seen = pair // (2 * wide) - v - 1, (c * 2 * wide + pair % (2 * wide)).tobytes()
        edges = (8 * np.searchsorted(word, np.arange(len(new) + 1))).tolist()
        return pd.DataFrame({"word": new, "seen": [seen[a:b] for a, b in zip(edges, edges[1:])]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        core, label = shared.value
        first = {w: i for i, w in enumerate(core)}
        places, flat, size = _Places(first), [], 0
        for rows in (b.iloc[i : i + CHUNK] for b in batches for i in range(0, len(b), CHUNK)):
            part: list[int] = []
            for t in rows["text"]:
                part.append(len(core))
                part += map(places.__getitem__, tokens(t))
            flat.append(np.array(part, dtype=np.int32))
            size += len(part)
            if len(places) > FLUSH or size > GATHER:
                yield rows_of(places, core, label, flat)
                places, flat, size = _Places(first), [], 0
        if flat:
            yield rows_of(places, core, label, flat)

    return _raw(texts).mapInPandas(run, "word binary, seen binary")


def assigned(texts: DataFrame, core: list[bytes], label: np.ndarray, classes: int, matrix: np.ndarray) -> DataFrame:
    """(word, c, class) of all words of ``texts`` outside the core: the class under which
    a word's occurrences are likeliest, of equal ones the first."""
    moves, totals = class_model(matrix, label)
    # Log10 likelihood of a neighbour before and after, with p(word | class) = c / total.
    before = moves[:, :classes] - np.log10(totals[:classes] + 1)
    shared = texts.sparkSession.sparkContext.broadcast(np.concatenate([before, moves[:classes].T]))
    wide = len(moves)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gain = shared.value

        def chosen(words: list[bytes], seen: np.ndarray) -> pd.DataFrame:
            best = np.round(seen @ gain, 9).argmax(axis=1) if words else []
            return pd.DataFrame({"word": words, "c": seen[:, wide:].sum(axis=1).astype(int), "class": best})

        word, sums = None, np.zeros((1, 2 * wide))
        for rows in batches:
            words: list[bytes] = [] if word is None else [word]
            group = []
            for w in map(bytes, rows["word"]):
                if not words or words[-1] != w:
                    words.append(w)
                group.append(len(words) - 1)
            if not words:
                continue
            number = np.frombuffer(b"".join(rows["seen"]), dtype=np.int64)
            at = np.repeat(np.array(group), [len(s) // 8 for s in rows["seen"]]) * 2 * wide + number % (2 * wide)
            seen = np.bincount(at, weights=number // (2 * wide), minlength=len(words) * 2 * wide).reshape(len(words), -1)
            seen[:1] += sums
            yield chosen(words[:-1], seen[:-1])
            word, sums = words[-1], seen[-1:]
        if word is not None:
            yield chosen([word], sums)

    found = neighbour_counts(texts, core, label)
    return found.repartition("word").sortWithinPartitions("word").mapInPandas(run, "word binary, c long, class int")


def fit(train: DataFrame, frequent: dict[bytes, int]) -> tuple[list[bytes], np.ndarray, int, DataFrame]:
    """The core, its classes, their number, and the table of all other words."""
    core = list(frequent)[:VOCABULARY]
    n = len(core) + RARE + 1
    matrix = np.zeros((n, n))
    found = bigram_counts(train, core).toArrow()
    matrix[found["a"].to_numpy(), found["b"].to_numpy()] = found["c"].to_numpy()
    classes = min(CLASSES, max(1, len(core)))
    label = exchange(matrix, len(core), classes)
    return core, label[: len(core)], classes, materialize(assigned(train, core, label, classes, matrix), "classes")


def class_strings(texts: DataFrame, table: dict[bytes, tuple[int, int]], words: DataFrame, classes: int, end: int, whole: float) -> DataFrame:
    """Per document: tokens, known ones, base score, log10(c + HALF) summed over known
    words, and the classes of its words as bytes. ``table`` has the words that travel
    with their counts and classes, ``words`` those and others. The other words of a text are
    listed in order, so the n-th one belongs to the n-th open place of its bytes."""
    shared = texts.sparkSession.sparkContext.broadcast(table)
    unseen = classes + 1
    schema = "doc_id long, key long, n_tokens long, n_known long, base double, model double, seq binary, others array<binary>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        places = _Known(list(table))
        c = np.array([x for x, _ in table.values()] + [0], dtype=float)
        kind = np.array([k for _, k in table.values()] + [OPEN], dtype=np.uint8)
        base_log, model_log = np.log10(c + 1), np.where(c > 0, np.log10(c + HALF), 0.0)
        last, end_base = len(table), float(np.log10(end + 1))
        parts = (b.iloc[i : i + CHUNK] for b in batches for i in range(0, len(b), CHUNK))
        for rows in parts:
            out: list[tuple] = []
            for t in rows["text"]:
                ws = tokens(t)
                at = np.fromiter(map(places.__getitem__, ws), np.int64, len(ws))
                gaps = np.flatnonzero(at == last).tolist()
                others = [ws[i] for i in gaps]
                base = end_base + float(base_log[at].sum()) - whole * (len(ws) + 1)
                out.append((len(ws) + 1, int(end > 0) + len(ws) - len(gaps), base, float(model_log[at].sum()), kind[at].tobytes(), others))
            done = pd.DataFrame(out, columns=["n_tokens", "n_known", "base", "model", "seq", "others"])
            yield pd.concat([rows[["doc_id", "key"]].reset_index(drop=True), done], axis=1)

    keyed = texts.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("text").cast("binary").alias("text"))
    parts = materialize(keyed.mapInPandas(run, schema), "parts")
    rest = parts.filter(F.size("others") > 0).dropDuplicates(["doc_id", "key"]).select("doc_id", "key", F.posexplode("others").alias("at", "word"))
    met = rest.join(words, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    place = F.col("at").cast("long") * 256 + F.coalesce("class", F.lit(unseen))
    sums = met.groupBy(F.col("doc_id").alias("d"), F.col("key").alias("q")).agg(
        F.sum((F.col("c") > 0).cast("long")).alias("more"),
        F.sum(F.log10(F.col("c") + 1)).alias("more_base"),
        F.sum(F.when(F.col("c") > 0, F.log10(F.col("c") + HALF)).otherwise(0.0)).alias("more_model"),
        F.collect_list(place).alias("places"),
    )
    whole_rows = parts.drop("others").join(sums, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("q")), "left")
    zero = F.lit(0.0)
    return whole_rows.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base"),
        (F.col("model") + F.coalesce("more_model", zero)).alias("model"), "seq", "places",
    ).mapInPandas(_filled, "doc_id long, n_tokens long, n_known long, base double, model double, seq binary")


def _filled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = []
        for seq, places in zip(rows["seq"], rows.pop("places")):
            if places is not None:
                at = np.array(places, dtype=np.int64)
                x = np.frombuffer(seq, dtype=np.uint8).copy()
                x[np.flatnonzero(x == OPEN)[at // 256]] = at % 256
                seq = x.tobytes()
            out.append(seq)
        rows["seq"] = out
        yield rows


def class_bigrams(strings: DataFrame, k: int, edge: int) -> np.ndarray:
    """How often one class precedes another, texts opened and closed by the edge."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mark, seen = bytes([edge]), np.zeros(k * k, dtype=np.int64)
        for rows in (b.iloc[i : i + CHUNK] for b in batches for i in range(0, len(b), CHUNK)):
            x = np.frombuffer(mark + b"".join(bytes(s) + mark for s in rows["seq"]), dtype=np.uint8).astype(np.int64)
            seen += np.bincount(x[:-1] * k + x[1:], minlength=k * k)
        pair = np.flatnonzero(seen)
        yield pd.DataFrame({"pair": pair, "c": seen[pair]})

    out = np.zeros(k * k)
    for r in strings.select("seq").mapInPandas(run, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c")).collect():
        out[r["pair"]] = r["c"]
    return out.reshape(k, k)


def op10_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(documents(spark, sf_dir))


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    train = texts.filter(~held_out(F.col("doc_id")))
    counts = materialize(word_counts(train), "words")
    once = F.count(F.when((F.col("c") == 1) & (F.col("word") != END), 1))
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), once.alias("once")).first()
    n, v, once = int(whole["n"] or 0), int(whole["v"]), int(whole["once"])
    end_row = counts.filter(F.col("word") == END).first()
    end = end_row["c"] if end_row else 0
    frequent = frequent_words(counts)
    core, label, classes, words = fit(train, frequent)
    table = {w: (frequent[w], int(k)) for w, k in zip(core, label)}
    if len(frequent) > len(core):
        found = words.filter(F.col("c") >= min(frequent.values())).select("word", "c", "class").toArrow().to_pydict()
        table |= {w: (c, k) for w, c, k in zip(found["word"], found["c"], found["class"])}
    strings = materialize(class_strings(texts, table, words, classes, end, float(np.log10(n + v + 1))), "strings")
    edge, k = classes, classes + 2
    big = class_bigrams(strings.filter(~held_out(F.col("doc_id"))), k, edge)
    moves, spread = final_model(big, _words_by_class(words, label, k), once)
    shared = docs.sparkSession.sparkContext.broadcast((moves, spread))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        moves, spread = shared.value
        mark = bytes([edge])
        for rows in batches:
            added = []
            for s in rows.pop("seq"):
                at = np.frombuffer(mark + bytes(s) + mark, dtype=np.uint8)
                added.append(float(moves[at[:-1], at[1:]].sum() - spread[at[1:-1]].sum()))
            rows["score"] = rows.pop("model") + np.array(added, dtype=float)
            yield rows

    out = strings.mapInPandas(run, "doc_id long, n_tokens long, n_known long, base double, score double")
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def _words_by_class(words: DataFrame, label: np.ndarray, k: int) -> np.ndarray:
    """Distinct words of each class, the core's and the others."""
    out = np.bincount(label, minlength=k).astype(float)
    for r in words.groupBy("class").count().collect():
        out[r["class"]] += r["count"]
    return out


def final_model(big: np.ndarray, words: np.ndarray, once: int) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the transitions, and by class what a word's log10(c + HALF) is lowered by.
    The last class is that of unseen words: as many as the words seen ``once``, with
    their share of the tokens after every class, and followed as any word is."""
    seen = big[:-1, :-1]
    total = seen.sum()
    share = (seen.sum(axis=0) + 1) / (total + len(seen))
    moves = (big[:, :-1] + PRIOR * share) / (big[:, :-1].sum(axis=1) + PRIOR)[:, None]
    unseen = (once + 1) / (total + 2)
    moves = np.concatenate([moves * (1 - unseen), np.full((len(big), 1), unseen)], axis=1)
    spread = np.log10(np.maximum(big.sum(axis=0) + HALF * words, HALF))
    spread[-1] = np.log10(once + 1)
    return np.log10(moves), spread
