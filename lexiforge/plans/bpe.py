"""Byte-pair-encoding training on counted sequences.

Each round is one rewrite of the sequences that are left, one pair count, one top-k; only the few thousand rows that the selection
looks at reach the driver. Rounds are cut by tables in the shared folder, so a lost executor costs tasks and not the run.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiforge.functions.text import codepoints
from lexiforge.operators.counts import conflict_free, text_counts, top_pairs
from lexiforge.operators.sampling import adaptive_min_frequency
from lexiforge.plans import resume
from lexiforge.plans.merging import apply_in_order, apply_merges, bounded_batches, rewritten
from lexiforge.storage import materialize

#: Ids of merged tokens begin behind the code points.
FIRST_MERGED = 0x110000


@dataclass
class Trained:
    tokens: dict[int, str] = field(default_factory=dict)
    #: (round, left, right, new id, count), in order.
    merges: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    rounds: list[dict] = field(default_factory=list)
    stopped: str = ""

    def text(self, symbol: int) -> str:
        return self.tokens.get(symbol) or chr(symbol)


def sequences(docs: DataFrame, text: str = "text") -> DataFrame:
    """(seq array<int>, count) of the different texts."""
    return text_counts(docs, text).select(codepoints(F.col("text")).alias("seq"), "count")


def symbol_pairs(seqs: DataFrame) -> DataFrame:
    """(a, b, cnt) of adjacent symbols, weighted by count."""
    n = F.size("seq")
    pairs = F.arrays_zip(F.slice("seq", 1, n - 1).alias("a"), F.slice("seq", 2, n - 1).alias("b"))
    return seqs.where(n > 1).select(F.explode(pairs).alias("p"), "count").groupBy("p.a", "p.b").agg(F.sum("count").cast("long").alias("cnt"))


def train(
    seqs: DataFrame, vocab_size: int, batch_merges: int = 12_000, min_frequency: int = 2, mode: str = "iterative", initial: int | None = None,
    max_rounds: int | None = None, specials: int = 0, folder: str | None = None,
) -> Trained:
    """Rounds of conflict-free merges until a stop rule of B03 holds.

    ``mode`` "iterative" rewrites the last round's sequences with the new merges; "single_pass" rewrites the raw sequences with
    all merges so far in one pass, so that no merge of a merged symbol is ever applied. With a ``folder`` every round is saved there, and a
    call with a folder that holds rounds goes on behind the last whole one (B07), with the sequences and settings it was begun with.
    """
    if mode not in ("iterative", "single_pass"):
        raise ValueError(f"unknown mode {mode!r}")
    base = materialize(seqs.where(F.size("seq") > 0), "sequences")
    done, now, by_text = Trained(), base, {}
    spark, next_id, table = seqs.sparkSession, FIRST_MERGED, {}
    saved = resume.latest(spark, folder) if folder else None
    if saved:
        _, now, state = saved
        done = Trained({int(k): v for k, v in state["tokens"].items()}, [tuple(m) for m in state["merges"]], state["rounds"])
        size, min_frequency, next_id = state["size"], state["min_frequency"], FIRST_MERGED + len(done.tokens)
        by_text, table = {v: k for k, v in done.tokens.items()}, {(a, b): s for _, a, b, s, _ in done.merges}
    else:
        size = specials + (initial if initial is not None else base.select(F.explode("seq").alias("s")).distinct().count())

    def kept(rows: DataFrame) -> DataFrame:
        if not folder:
            return materialize(rows, "round")
        state = {"tokens": done.tokens, "merges": done.merges, "rounds": done.rounds, "size": size, "min_frequency": min_frequency}
        resume.save_round(spark, folder, len(done.rounds) - 1, rows, state)
        return resume.latest(spark, folder)[1]

    while True:
        if size + len(done.merges) >= vocab_size:
            done.stopped = "vocabulary is full"
            break
        if max_rounds is not None and len(done.rounds) >= max_rounds:
            done.stopped = "rounds are used up"
            break
        if not done.rounds:
            rows = now.count()
            if not rows:
                done.stopped = "no sequences"
                break
            min_frequency = adaptive_min_frequency(rows, min_frequency)
        pairs = symbol_pairs(now).where(F.col("cnt") >= min_frequency)
        # The excluded pairs are the merge list itself, which the vocabulary size bounds.
        past = now.sparkSession.createDataFrame([m[1:3] for m in done.merges] or [(-1, -1)], "a int, b int")
        ranked = [tuple(r) for r in top_pairs(pairs, 3 * batch_merges, 1, past if done.merges else None).collect()]
        if not ranked:
            done.stopped = "no candidates"
            break
        chosen = conflict_free(ranked, min(batch_merges, vocab_size - size - len(done.merges)))
        if not chosen:
            done.stopped = "none accepted"
            break
        fresh, new_tokens = [], 0
        for a, b, cnt in chosen:
            text = done.text(a) + done.text(b)
            symbol = by_text.get(text)
            if symbol is None:
                symbol = by_text[text] = next_id
                done.tokens[next_id] = text
                next_id += 1
                new_tokens += 1
            table[a, b] = symbol
            fresh.append((a, b, symbol))
            done.merges.append((len(done.rounds), a, b, symbol, cnt))
        counts = [c for *_, c in chosen]
        done.rounds.append({"round": len(done.rounds), "accepted": len(chosen), "new_tokens": new_tokens, "least": min(counts), "mean": sum(counts) / len(counts), "most": max(counts)})
        if not new_tokens:
            done.stopped = "no new tokens"
            break
        if mode == "iterative":
            reused = [(a, b, s) for (a, b), s in table.items() if s in {m[2] for m in fresh}]
            now = kept(apply_merges(now, "seq", {*fresh, *reused}))
        else:
            now = kept(apply_merges(base, "seq", [(a, b, s) for (a, b), s in table.items()]))
    return done


class WordTrainer:
    """One merge at a time over (symbols, count) words, with an index from pairs to the words that hold them.

    All words lie in one array, each at a place of its own; a merge gathers the words that its pair's index lists, rewrites them together and
    counts only the pairs that this changes.
    """

    def __init__(self, words: list[tuple[Sequence[str], int]]):
        size = np.array([len(w) for w, _ in words], np.int64)
        self.names = sorted({s for w, _ in words for s in w})
        at = {s: k for k, s in enumerate(self.names)}
        self.symbols = np.fromiter((at[s] for w, _ in words for s in w), np.int64, int(size.sum()))
        self.start, self.size = np.cumsum(size) - size, size
        self.weight = np.array([c for _, c in words], np.int64)

    @classmethod
    def of(cls, rows: pa.Table, merged: dict[int, str]) -> WordTrainer:
        """The trainer of (seq, count) rows of symbols, code points or the numbers of ``merged`` tokens, without a Python object for a row."""
        parts = [_flat_words(b) for b in rows.to_batches()]
        new = cls([])
        flat = np.concatenate([v for v, _, _ in parts] or [np.zeros(0, np.int32)])
        used, new.symbols = np.unique(flat, return_inverse=True)
        new.names = [merged.get(s) or chr(s) for s in used.tolist()]
        new.size = np.concatenate([np.diff(o) for _, o, _ in parts] or [np.zeros(0, np.int64)])
        new.start = np.cumsum(new.size) - new.size
        new.weight = np.concatenate([w for _, _, w in parts] or [np.zeros(0, np.int64)])
        return new

    def _gathered(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the chosen words, and where each begins and the last ends."""
        size = self.size[chosen]
        offsets = np.concatenate(([0], np.cumsum(size)))
        return self.symbols[np.repeat(self.start[chosen] - offsets[:-1], size) + np.arange(offsets[-1])], offsets

    @staticmethod
    def _pairs(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, number of the word) of each adjacent pair inside a word."""
        word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        inside = word[1:] == word[:-1]
        return ((values[:-1] << 32) | values[1:])[inside], word[1:][inside]

    def run(self, vocab_size: int, min_frequency: int = 2, alphabet: list[str] | None = None) -> tuple[list[str], list[tuple[str, str, int]]]:
        """(tokens by id, merges with their counts); of equal counts the pair with the smaller ids is first."""
        tokens = list(dict.fromkeys([*(alphabet or []), *self.names]))
        ids = {t: k for k, t in enumerate(tokens)}
        self.symbols = np.array([ids[t] for t in self.names], np.int64)[self.symbols] if self.names else self.symbols
        where: dict[int, list[np.ndarray]] = defaultdict(list)
        count: dict[int, int] = {}

        def listed(keys: np.ndarray, words: np.ndarray) -> None:
            order = np.argsort(keys, kind="stable")
            keys, words = keys[order], words[order]
            cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else []
            for key, part in zip(keys[cuts].tolist(), np.split(words, cuts[1:])) if len(keys) else ():
                where[key].append(part)

        def changed(keys: np.ndarray, weights: np.ndarray) -> list[int]:
            each, back = np.unique(keys, return_inverse=True)
            by = np.zeros(len(each), np.int64)
            np.add.at(by, back, weights)
            moved = each[by != 0].tolist()
            for key, n in zip(moved, by[by != 0].tolist()):
                count[key] = count.get(key, 0) + n
            return moved

        keys, words = self._pairs(*self._gathered(np.arange(len(self.size))))
        listed(keys, words)
        entry = lambda key: (-count[key], key >> 32, key & 0xFFFFFFFF)
        heap = [entry(key) for key in changed(keys, self.weight[words]) if count[key] > 0]
        heapq.heapify(heap)
        merges = []
        while heap and len(tokens) < vocab_size:
            negative, left, right = heapq.heappop(heap)
            key = left << 32 | right
            now = count.get(key, 0)
            if -negative != now:
                if 0 < now < -negative:
                    heapq.heappush(heap, entry(key))
                continue
            if now < max(1, min_frequency):
                break
            text = tokens[left] + tokens[right]
            new = ids.setdefault(text, len(tokens))
            if new == len(tokens):
                tokens.append(text)
            merges.append((tokens[left], tokens[right], now))
            chosen = np.unique(np.concatenate(where.pop(key)))
            old, offsets = self._gathered(chosen)
            made, behind = rewritten(old, offsets, np.array([left]), np.array([right]), np.array([new]))
            shorter = np.diff(behind) < np.diff(offsets)
            old_keys, old_words = self._pairs(old, offsets)
            new_keys, new_words = self._pairs(made, behind)
            old_keys, old_words = old_keys[shorter[old_words]], chosen[old_words[shorter[old_words]]]
            new_keys, new_words = new_keys[shorter[new_words]], chosen[new_words[shorter[new_words]]]
            self.size[chosen] = np.diff(behind)
            self.symbols[np.repeat(self.start[chosen] - behind[:-1], np.diff(behind)) + np.arange(behind[-1])] = made
            fresh = ((new_keys >> 32) == new) | ((new_keys & 0xFFFFFFFF) == new)
            listed(new_keys[fresh], new_words[fresh])
            for k in changed(np.concatenate((old_keys, new_keys)), np.concatenate((-self.weight[old_words], self.weight[new_words]))):
                if k != key and count[k] > 0:
                    heapq.heappush(heap, entry(k))
            count.pop(key, None)
        return tokens, merges


def train_words(words: DataFrame, vocab_size: int, min_frequency: int = 2, specials: list[str] | None = None, driver_limit: int = 2_000_000) -> tuple[list[str], list[tuple[str, str, int]]]:
    """B04 on (token, count) words. The merge loop is sequential and runs on the driver on at most ``driver_limit`` different words;
    more are refused, and ``train_all_words`` is the way for them."""
    rows = words.where("token <> ''").limit(driver_limit + 1).collect()
    if len(rows) > driver_limit:
        raise ValueError(f"over {driver_limit} different words: use the distributed rounds of train()")
    special = list(dict.fromkeys(specials or []))
    tokens, merges = WordTrainer([(r["token"], r["count"]) for r in rows]).run(vocab_size - len(special), min_frequency)
    return special + tokens, merges


def _flat_words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, offsets and counts of (seq, count) words."""
    offsets = batch.column(0).offsets.to_numpy().astype(np.int64)
    return batch.column(0).values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0], batch.column(1).to_numpy(zero_copy_only=False)


def _fragments(seqs: DataFrame, frequent: list[tuple[int, int]]) -> DataFrame:
    """(seq, count): the words cut inside all pairs that are not in ``frequent``; single symbols are left out."""
    table = np.array(sorted(a << 32 | b for a, b in frequent), np.int64)

    def run(batches):
        for batch in batches:
            values, offsets, weight = _flat_words(batch)
            keys = values[:-1].astype(np.int64) << 32 | values[1:]
            begins = np.ones(len(values) + 1, bool)
            begins[1:-1] = table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] != keys
            begins[offsets] = True
            at = np.flatnonzero(begins)
            size = np.diff(at)
            kept = size > 1
            word = np.searchsorted(offsets, at[:-1][kept], "right") - 1
            seq = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size[kept]))).astype(np.int32)), pa.array(values[np.repeat(kept, size)].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([seq, pa.array(weight[word])], names=["seq", "count"])

    return seqs.mapInArrow(run, "seq array<int>, count long").groupBy("seq").agg(F.sum("count").cast("long").alias("count"))


def _while_bounded(merges: list[tuple[str, str, int]], known: set[str]) -> list[tuple[str, str, int]]:
    """The merges up to the first that makes a token anew out of other outer symbols; those ``known`` at the round's beginning are their own."""
    ends = {t: (t, t) for t in known}
    for k, (left, right, _) in enumerate(merges):
        now = (ends[left][0], ends[right][1])
        if ends.setdefault(left + right, now) != now:
            return merges[: k + 1]
    return merges


#: So many kinds of pairs at most reach the driver.
RANKED = 20_000


def train_words_rounds(words: DataFrame, vocab_size: int, min_frequency: int = 2, specials: list[str] | None = None, driver_limit: int = 2_000_000) -> tuple[list[str], list[tuple[str, str, int]]]:
    """B04 for any number of different words: the merges of ``train_words``, many a round.

    Wherever a pair stands after further merges, the outer symbols of its parts that meet there make a pair now, so it is never more frequent than
    that pair is now. A round picks a least count, cuts the words inside all rarer pairs and counts equal fragments together: they hold every
    pair of that count or more, now and later, and are fewer than the words. The driver merges them down to that count. That needs a token
    to have the same outer symbols wherever it stands; a round ends with the merge that makes one out of others. If not even the fragments of
    the most frequent pair are few enough, that pair alone is merged.
    """
    bounded_batches(words.sparkSession)
    now = materialize(words.where("token <> ''").select(codepoints(F.col("token")).alias("seq"), "count"), "words")
    special, least_ok = list(dict.fromkeys(specials or [])), max(1, min_frequency)
    tokens = sorted(chr(r["s"]) for r in now.select(F.explode("seq").alias("s")).distinct().collect())  # an alphabet
    # Code points are ordered as the alphabet is and merged tokens come behind, so symbols break ties as ids do.
    symbol, names, merges, wanted, deepest = {t: ord(t) for t in tokens}, {}, [], vocab_size - len(special), RANKED
    while len(tokens) < wanted:
        ranked = top_pairs(symbol_pairs(now), RANKED + 1, least_ok).collect()
        if not ranked:
            break
        # Of pairs that are as frequent as the last, more may have been left out.
        whole = ranked if len(ranked) <= RANKED else [r for r in ranked if r["cnt"] > ranked[-1]["cnt"]]
        tried, fresh = min(len(whole), deepest), []
        while tried and not fresh:
            least = whole[tried - 1]["cnt"]
            fragments = materialize(_fragments(now, [(r["a"], r["b"]) for r in whole if r["cnt"] >= least]), "fragments")
            if fragments.count() <= driver_limit:
                fresh = _while_bounded(WordTrainer.of(fragments.toArrow(), names).run(wanted, least, tokens)[1], set(tokens))
                deepest = 2 * tried
            tried //= 2
        if not fresh:
            left, right = (names.get(s) or chr(s) for s in (ranked[0]["a"], ranked[0]["b"]))
            fresh = [(left, right, ranked[0]["cnt"])]
        for text in (a + b for a, b, _ in fresh):
            if text not in symbol:
                symbol[text] = FIRST_MERGED + len(names)
                names[symbol[text]] = text
                tokens.append(text)
        merges += fresh
        if len(tokens) < wanted:
            now = materialize(apply_in_order(now, "seq", [(symbol[a], symbol[b], symbol[a + b]) for a, b, _ in fresh]), "words")
    return special + tokens, merges


def train_all_words(words: DataFrame, vocab_size: int, min_frequency: int = 2, specials: list[str] | None = None, driver_limit: int = 2_000_000) -> tuple[list[str], list[tuple[str, str, int]]]:
    """On the driver up to ``driver_limit`` different words, by ``train_words_rounds`` beyond; the results are the same."""
    words = materialize(words, "word_counts")
    few = words.where("token <> ''").count() <= driver_limit
    return (train_words if few else train_words_rounds)(words, vocab_size, min_frequency, specials, driver_limit)


def add_batch(folder: str, name: str, words: DataFrame) -> DataFrame:
    """The (token, count) words of a batch, counted once under its name however often it is given."""
    return resume.once(words.sparkSession, f"{folder}/batch={name}", lambda: words.select("token", "count"))


def batch_counts(spark, folder: str) -> DataFrame:
    """(token, count) over all batches so far; training on it is training on all their texts."""
    return spark.read.schema("token string, count long").parquet(f"{folder}/batch=*").groupBy("token").agg(F.sum("count").cast("long").alias("count"))


def missing_specials(vocabulary: DataFrame, specials: list[str]) -> DataFrame:
    """(ord, token) of the special tokens that a vocabulary (token) lacks, in order."""
    wanted = vocabulary.sparkSession.createDataFrame(list(enumerate(dict.fromkeys(specials))), "ord long, token string")
    return wanted.join(vocabulary.select("token"), "token", "left_anti").select("ord", "token")


def with_specials(vocabulary: DataFrame, specials: list[str]) -> DataFrame:
    """A vocabulary (token, id) with the special tokens it lacks behind its last id."""
    last = vocabulary.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("last"))
    lacking = missing_specials(vocabulary, specials).crossJoin(F.broadcast(last))  # a row for each special token
    at = F.row_number().over(Window.orderBy("ord"))
    return vocabulary.select("token", "id").union(lacking.select("token", (F.col("last") + at).cast("long")))


def assigned_ids(tokens: DataFrame, vocabulary: DataFrame, first: int) -> DataFrame:
    """(ord, token, id): a token (ord, token) of a round keeps the id it has in the vocabulary; new ones get ids from ``first`` on, in order."""
    known = tokens.join(vocabulary.select("token", "id"), "token", "left")
    fresh = F.row_number().over(Window.partitionBy(F.col("id").isNull()).orderBy("ord"))  # the merges of one round
    return known.select("ord", "token", F.coalesce("id", F.lit(first) + fresh - 1).cast("long").alias("id"))


def artifacts(tokens: list[str], merges: list[tuple[str, str]], specials: list[str], extra: dict | None = None) -> dict[str, str]:
    """File name -> content. Merges are also written as JSON pairs, since a token may hold spaces."""
    order = list(dict.fromkeys([*specials, *tokens]))
    vocab = {t: k for k, t in enumerate(order)}
    shown = lambda t: t.replace(" ", "Ġ").replace("\n", "Ċ")
    info = {"vocab_size": len(vocab), "merges": len(merges), "special_tokens": specials, **(extra or {})}
    dump = lambda x: json.dumps(x, ensure_ascii=False, indent=1)
    return {
        "vocab.json": dump(vocab), "merges.json": dump([list(m) for m in merges]), "merges.txt": "#version: 0.2\n" + "".join(f"{shown(a)} {shown(b)}\n" for a, b in merges),
        "tokenizer_info.json": dump(info), "tokenizer_config.json": dump({"model_type": "bpe", "vocab_size": len(vocab)}),
        "special_tokens_map.json": dump({f"token_{k}": t for k, t in enumerate(specials)}), "added_tokens.json": dump({t: vocab[t] for t in specials}),
    }
