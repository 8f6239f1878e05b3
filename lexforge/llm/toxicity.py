"""Toxicity: a weighted finite-state pattern grammar over clauses.

Words are read as weighted signs (insult, harm, intent, target, negation, reported
speech, other). Small weighted transducers rewrite the signs of a clause:

- reported speech: an insult or harm after a verb of saying is another's word;
- negation: an insult or harm within three words after a negation is denied;
- threat: harm counts if intent (will, going to, ...) comes before it;
- target: a person addressed or named within reach turns an insult or threat into
  one that is aimed.

They are composed into one deterministic machine, whose arcs carry the products of
the weights of the arcs they are made of. What it puts out are events; an event
weighs its word's weight times the weight of its path. A text is cut into clauses,
and the events of matched clauses are what scores it, never a word alone.

The lexical arcs are learned, in whatever language the texts are. Entries are whole
words and word beginnings; an entry's weight is the smoothed log-odds of its document
frequency in toxic against clean labelled texts, and entries are kept whose
association passes a likelihood-ratio test. Arcs along a word form a trie whose path
sums to the weight of the longest entry that the word begins with. An entry that
mostly follows intent in toxic texts is a harm, any other an insult. A small fixed
lexicon holds the closed classes, and insults for which no label was seen.

The scale of every kind of event, and of the text's length, is fitted by logistic
regression over the labelled texts' events, where a text's events come from entries
learned on the other folds; so a score is a probability of the label, and not of
having been seen. Near copies would make each of their words an entry: labelled texts
that share a MinHash value of their word 5-grams are a family, the toxic and the clean
texts of a family weigh as much as one text each, and a family is in one fold.

Defined cases: null and empty texts have no clause and score the bias; texts are
scored row by row, whatever repeats; a text of any length is read whole, in time
proportional to its length; entries with equal evidence are taken in their own order;
an empty table gives no row; without labelled rows the weights are ``PRIOR`` and the
entries the fixed ones; other columns, of any name, are ignored.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.common import bounded_broadcast, ragged, slices, table, text_column, written
from lexforge.llm.jaccard import n_grams, signatures

# The lexicon, by sign. I insult, H harm, W intent, T target, N negation, R reported speech.
LEXICON = {
    "I": "idiot idiots moron morons scum loser losers trash pathetic worthless disgusting stupid clown clowns fool fools dumb dumbass imbecile imbeciles vermin filth filthy garbage "
    "pig pigs rat rats parasite parasites cretin cretins jerk jerks bastard bastards bitch bitches asshole assholes shit shitty fuck fucking crap creep creeps freak freaks ugly useless "
    "brainless degenerate degenerates subhuman subhumans retard retarded retards whore slut hag coward cowards liar liars dimwit halfwit nitwit lowlife scumbag scumbags "
    "idiota estúpido estúpida imbécil basura asqueroso patético inútil idioten dumm dummkopf abschaum arschloch ekelhaft wertlos erbärmlich idiote stupide imbécile ordure minable dégoûtant connard salope",
    "H": "kill murder hurt destroy beat smash shoot stab hang burn crush strangle attack punch exterminate töten tuer matar",
    "W": "will shall gonna going must should deserve deserves ought i'll we'll they'll werde vais voy",
    "T": "you your you're yourself u ur he him his she her they them their these those people person everyone anyone guy guys man men woman women du ihr sie tu vous toi tú usted ustedes",
    "N": "not no never isn't aren't wasn't weren't don't doesn't didn't won't wouldn't can't cannot nobody hardly nicht kein keine pas jamais nunca",
    "R": "said says say saying called calls calling wrote writes quoted quotes reported claims claimed accused alleged sagte schrieb dit écrit dijo escribió",
}
SIGNS = {word: sign for sign, words in LEXICON.items() for word in words.split()}

#: Kinds of events. i insult, a aimed insult, d denied, q reported, t threat, x aimed threat.
EVENTS = "iadqtx"
#: Weights of arcs that rewrite: another's word, denied, a threat, and one that finds its target.
REPORTED, DENIED, THREAT, AIMED = 0.25, 0.25, 1.5, 1.5
#: The weight of a word of the fixed lexicon, as long as labels say nothing of it.
FIXED_WEIGHT = 4.0
#: Weights before any label is seen: the bias, then one for each kind of event, then the text's length.
PRIOR = np.array([-3.0, 2.0, 2.0, 1.0, 1.0, 2.0, 2.0, 0.0])
REACH = 3
#: Events of the sign that is held; they have the weight of its path, not of the path at hand.
HELD = "iatx"
#: Lengths of word beginnings.
SHORTEST, LONGEST = 3, 8
#: What an entry needs: documents, log-odds, and the likelihood-ratio statistic.
LEAST_DOCS, LEAST_ODDS, LEAST_RATIO = 4, 1.0, 24.0
#: The size of the model: the entries with the strongest association.
MOST_ENTRIES = 50_000
FOLDS = 4
#: MinHash values of a labelled text, by which families are found; the weight of a family's label.
SKETCHES, UNIT = 6, 1 << 30
#: Bytes of text at a time; a longer text stands alone.
LEARN_BYTES, SCORE_BYTES = 2 << 20, 6 << 20
#: The most labelled rows that fitting reads, the least hashes of their ids; a documented bound.
MOST_LABELLED = 50_000


class Transducer:
    """A deterministic weighted transducer.

    steps: (state, sign) to (state, outputs); last: what a state puts out at the end.
    Outputs are (symbol, weight). ``h`` holds the weight of the sign that was read;
    HELD are events of the held sign, ``A X q d`` events of the sign at hand.
    """

    def __init__(self, steps: dict, last: dict, start=0):
        self.steps, self.last, self.start = steps, last, start

    def then(self, after: "Transducer") -> "Transducer":
        """The composition: what this puts out is read by ``after``; weights multiply along the path."""

        def read(state, outputs):
            made = []
            for symbol, weight in outputs:
                state, found = after.steps[state, symbol]
                made += [(s, w if s in HELD else weight * w) for s, w in found]
            return state, tuple(made)

        signs: dict = {}
        for state, sign in self.steps:
            signs.setdefault(state, []).append(sign)
        start = (self.start, after.start)
        steps, last, todo, seen = {}, {}, [start], {start}
        while todo:
            here = todo.pop()
            state, made = read(here[1], self.last.get(here[0], ()))
            last[here] = made + tuple(after.last.get(state, ()))
            for sign in signs[here[0]]:
                there, outputs = self.steps[here[0], sign]
                state, made = read(here[1], outputs)
                steps[here, sign] = ((there, state), made)
                if (there, state) not in seen:
                    seen.add((there, state))
                    todo.append((there, state))
        names = {s: i for i, s in enumerate(sorted(seen, key=str))}
        return Transducer({(names[s], x): (names[n], o) for (s, x), (n, o) in steps.items()}, {names[s]: o for s, o in last.items()}, names[start])

    def run(self, signs, weights, totals: np.ndarray) -> None:
        """Adds the weights of the events of one clause to ``totals``, in the order of EVENTS."""
        state, held = self.start, 0.0
        for sign, weight in zip(signs, weights, strict=True):
            state, outputs = self.steps[state, sign]
            for symbol, w in outputs:
                if symbol == "h":
                    held = weight * w
                else:
                    totals[EVENTS.index(symbol.lower())] += w * (held if symbol in HELD else weight)
        for symbol, w in self.last.get(state, ()):
            totals[EVENTS.index(symbol)] += w * held


def reported() -> Transducer:
    """After R, I and H are another's (q); R itself is read as any word from there on."""
    steps = {}
    for said in (0, 1):
        for s in "IHWTNO":
            steps[said, s] = (said, (("q", REPORTED),) if said and s in "IH" else ((s, 1.0),))
        steps[said, "R"] = (1, (("O", 1.0),))
    return Transducer(steps, {})


def negation() -> Transducer:
    """Within REACH signs after N, I and H are denied (d)."""
    steps = {}
    for left in range(REACH + 1):
        for s in "IHWTOq":
            steps[left, s] = (max(0, left - 1), (("d", DENIED),) if left and s in "IH" else ((s, 1.0),))
        steps[left, "N"] = (REACH, (("O", 1.0),))
    return Transducer(steps, {})


def threat() -> Transducer:
    """H after intent is a threat (K), else any word."""
    steps = {}
    for wish in (0, 1):
        for s in "ITOqd":
            steps[wish, s] = (wish, ((s, 1.0),))
        steps[wish, "W"] = (1, (("O", 1.0),))
        steps[wish, "H"] = (wish, (("K", THREAT),) if wish else (("O", 1.0),))
    return Transducer(steps, {})


def target() -> Transducer:
    """A target up to REACH signs before or after aims an insult or a threat. Only events are put out.

    States: (signs left after a target, event that waits for one, signs it still waits).
    """
    steps, last = {}, {}
    states = [(n, "", 0) for n in range(REACH + 1)] + [(0, w, m) for w in "it" for m in range(1, REACH + 1)]
    aimed, events = {"i": "a", "t": "x"}, {"I": "i", "K": "t"}
    for n, w, m in states:
        alone = ((w, 1.0),) if w else ()
        last[n, w, m] = alone
        for s in "OTqdIK":
            if s == "T":
                steps[(n, w, m), s] = ((REACH, "", 0), ((aimed[w], AIMED),) if w else ())
            elif s in events and n:  # aimed at once
                steps[(n, w, m), s] = ((n - 1, "", 0), ((aimed[events[s]].upper(), AIMED),))
            elif s in events:  # what waited has had its chance
                steps[(n, w, m), s] = ((0, events[s], REACH), (*alone, ("h", 1.0)))
            else:
                here = ((s, 1.0),) if s in "qd" else ()
                steps[(n, w, m), s] = ((max(0, n - 1), "", 0), alone + here) if m <= 1 else ((0, w, m - 1), here)
    return Transducer(steps, last, (0, "", 0))


def grammar() -> Transducer:
    return reported().then(negation()).then(threat()).then(target())


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Codes of all words and clause ends, how many each text has, and the code's words; a clause end is '.'.

    Words are runs of letters, with apostrophes between, in lower case; a clause ends at . ! ? ; or a new line.
    """
    low = pc.replace_substring(pc.utf8_lower(texts), "’", "'")
    low = pc.replace_substring_regex(low, r"[^\pL'.!?;\n]+", " ")
    lists = pc.split_pattern(pc.replace_substring_regex(low, r"[.!?;\n]+", " . "), " ")
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    coded = lists.flatten().dictionary_encode()
    names, places = [], {}
    # words that differ in outer apostrophes only are one
    of = np.fromiter((places.setdefault(x.strip("'"), len(places)) for x in coded.dictionary.to_pylist()), np.int64, count=len(coded.dictionary))
    names = list(places)
    codes = of[np.asarray(coded.indices, dtype=np.int64)] if len(names) else np.zeros(0, np.int64)
    some = codes != places.get("", -1)
    ends = np.concatenate([[0], np.cumsum(some)])[offsets - offsets[0]]
    return codes[some], np.diff(ends), names


class Lexicon:
    """Words as weighted signs: the fixed closed classes, then entries (a word, or a beginning with '-')."""

    def __init__(self, entries: dict[str, tuple[str, float]]):
        self.entries = {w: (s, FIXED_WEIGHT) for w, s in SIGNS.items() if s in "IH"} | entries
        # no word whose beginning isn't here has an entry
        self.heads = {e[:SHORTEST].rstrip("-") for e in self.entries}

    def sign(self, word: str) -> tuple[str, float]:
        if (fixed := SIGNS.get(word, "I")) not in "IH":
            return fixed, 0.0
        if word[:SHORTEST] in self.heads:
            if found := self.entries.get(word):
                return found
            for k in range(min(len(word) - 1, LONGEST), SHORTEST - 1, -1):
                if found := self.entries.get(word[:k] + "-"):
                    return found
        return "O", 0.0


_MACHINE: list[Transducer] = []


def events(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """The weight of EVENTS over the clauses of each text, and its number of words."""
    totals = np.zeros((len(texts), len(EVENTS) + 1))
    if not _MACHINE:
        _MACHINE.append(grammar())
    for i, j in slices(texts, SCORE_BYTES):
        codes, sizes, names = tokens(texts.slice(i, j - i))
        if not len(codes):
            continue
        signs, weights = zip(*map(lexicon.sign, names), strict=True)
        evil = np.array([s in "IH" for s in signs], bool)
        ends = np.array([x == "." for x in names], bool)
        text = np.repeat(np.arange(i, j), sizes)
        totals[i:j, -1] = np.bincount(text[~ends[codes]] - i, minlength=j - i)
        begins = np.concatenate([[True], ends[codes[:-1]] | (text[1:] != text[:-1])])
        clause = np.cumsum(begins) - 1
        firsts = np.append(np.flatnonzero(begins), len(codes))
        for c in np.unique(clause[evil[codes]]).tolist():
            # the end itself is no word; it comes last in its clause
            here = [k for k in codes[firsts[c] : firsts[c + 1]].tolist() if names[k] != "."]
            _MACHINE[0].run([signs[k] for k in here], [weights[k] for k in here], totals[text[firsts[c]]])
    return totals


def entries_of(word: str) -> list[str]:
    return [word, *(word[:k] + "-" for k in range(SHORTEST, min(LONGEST, len(word) - 1) + 1))]


def entry_counts(texts: pa.Array, kinds: np.ndarray, units: np.ndarray, n_kinds: int) -> tuple[list[str], np.ndarray]:
    """Entries, and for each: units of the texts with it, by kind; its words in toxic texts, in units, and those after intent in a clause."""
    codes, sizes, names = tokens(texts)
    if not len(codes):
        return [], np.zeros((0, n_kinds + 2), np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    ends = np.array([x == "." for x in names], bool)[codes]
    wish = np.array([SIGNS.get(x) == "W" for x in names], bool)[codes]
    begins = np.flatnonzero(np.concatenate([[True], ends[:-1] | (text[1:] != text[:-1])]))
    before = np.cumsum(wish) - wish
    after = before > np.repeat(before[begins], np.diff(np.append(begins, len(codes))))
    words, after, text = codes[~ends], after[~ends], text[~ends]

    places: dict[str, int] = {}
    lists = [[places.setdefault(e, len(places)) for e in entries_of(x)] for x in names]
    lengths = np.array([len(x) for x in lists], np.int64)
    flat = np.concatenate([np.array(x, np.int64) for x in lists])
    starts = np.cumsum(lengths) - lengths
    of_text, of_word = np.divmod(np.unique(text * len(names) + words), len(names))
    out = np.zeros((len(places), n_kinds + 2), np.int64)
    pair = np.unique(flat[ragged(starts[of_word], lengths[of_word])] * len(texts) + np.repeat(of_text, lengths[of_word]))
    entry, text_of = np.divmod(pair, len(texts))
    np.add.at(out, (entry, kinds[text_of]), units[text_of])
    toxic = kinds[text] % 2 == 1
    for column, use in ((n_kinds, toxic), (n_kinds + 1, toxic & after)):
        by_word = np.zeros(len(names), np.int64)
        np.add.at(by_word, words[use], units[text[use]])
        np.add.at(out[:, column], flat, np.repeat(by_word, lengths))
    some = out[:, :n_kinds].sum(1) > 0
    entries = list(places)
    return [entries[k] for k in np.flatnonzero(some)], out[some]


def likelihood_ratio(a, b, toxic, clean) -> np.ndarray:
    """Twice the log-likelihood ratio of a of ``toxic`` and b of ``clean`` documents with an entry, against one share for both."""
    total = np.zeros(np.broadcast(a, b).shape)
    share = (a + b) / max(toxic + clean, 1)
    for seen, of in ((a, toxic), (b, clean)):
        for got, expected in ((seen, of * share), (of - seen, of * (1 - share))):
            total += 2 * got * np.log(np.maximum(got, 1e-300) / np.maximum(expected, 1e-300))
    return total


def lexicon_of(names: list[str], counts: np.ndarray, after: np.ndarray, kinds: np.ndarray) -> Lexicon:
    """counts: (entry, clean and toxic); after: (entry, words in toxic texts and those after intent); kinds: texts, clean and toxic."""
    b, a = counts[:, 0], counts[:, 1]
    odds = np.log((a + 0.5) / (kinds[1] + 1)) - np.log((b + 0.5) / (kinds[0] + 1))
    good = (a >= LEAST_DOCS) & (odds >= LEAST_ODDS) & (likelihood_ratio(a, b, kinds[1], kinds[0]) >= LEAST_RATIO)
    harm = 2 * after[:, 1] > after[:, 0]
    found = {names[k]: (SIGNS.get(names[k]) or ("H" if harm[k] else "I"), float(odds[k])) for k in np.flatnonzero(good)}
    return Lexicon({x: v for x, v in found.items() if v[0] in "IH"})


def features(totals: np.ndarray) -> np.ndarray:
    """1, and the logarithm of each kind's weight and of the words."""
    return np.concatenate([np.ones((len(totals), 1)), np.log1p(totals)], axis=1)


def fit(totals: np.ndarray, labels: np.ndarray, rows: np.ndarray, strength: float = 1.0, steps: int = 100) -> np.ndarray:
    """Weights of texts that count as ``rows`` texts each, by Newton's method, pulled towards PRIOR as ``strength`` rows would; a step is halved until it lowers the loss."""
    x, y, w = features(totals), labels.astype(float), PRIOR.copy()
    pull = np.diag([0.1] + [strength] * (len(PRIOR) - 1))

    def loss(w):
        z = x @ w
        return np.sum(rows * (np.logaddexp(0, z) - y * z)) + (w - PRIOR) @ pull @ (w - PRIOR) / 2

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -700, 700)))
        gradient = x.T @ (rows * (p - y)) + pull @ (w - PRIOR)
        hessian = (x * (rows * p * (1 - p))[:, None]).T @ x + pull
        step, now = np.linalg.solve(hessian, gradient), loss(w)
        while np.abs(step).max() >= 1e-9 and not loss(w - step) <= now:
            step = step / 2
        if np.abs(step).max() < 1e-9:
            break
        w = w - step
    return w


class Model:
    """A lexicon, and the weights of the kinds of events."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(events(texts, self.lexicon)) @ self.weights, -700, 700)))


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """text, kind (twice the fold, and the label), units of labelled documents whose crc32(doc_id) mod 3 isn't 1, at most ``most`` labels."""
    rows = labels.select(F.col("doc_id").cast("long").alias("of"), F.col("toxic").cast("int").alias("label")).filter(F.col("label").isin(0, 1) & ~held_out(F.col("of")))
    if (n := rows.count()) > most:
        # about twice as many rows as are wanted go on to the sort, however many there are
        rows = rows.filter(F.xxhash64("of") <= int(min(2 * most / n, 1) * (1 << 64)) - (1 << 63) - 1)
    rows = rows.orderBy(F.xxhash64("of"), "of", "label").limit(most)
    # at most ``most`` rows of 12 bytes: a proven bound for the broadcast
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    of_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(F.broadcast(rows), F.col("doc_id") == F.col("of"))

    def sketch(batches):
        for batch in batches:
            texts = text_column(batch)
            for i, j in slices(texts, LEARN_BYTES):
                values = signatures(*n_grams(texts.slice(i, j - i)), SKETCHES, 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * SKETCHES), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in ("row", "text", "label")), lists], ["row", "text", "label", "sketches"])

    texts = written(of_docs.select(F.monotonically_increasing_id().alias("row"), "text", "label").mapInArrow(sketch, "row long, text string, label int, sketches array<long>"), "labelled-texts")
    values = texts.select("row", "label", F.posexplode("sketches").alias("place", "value"))
    # at most SKETCHES / 2 rows for each of ``most`` labelled rows are shared, and as many families: proven bounds for both broadcasts
    common = values.groupBy("place", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    families = values.join(F.broadcast(common), ["place", "value"], "left").withColumn("n", F.coalesce("n", F.lit(1))).groupBy("row", "label").agg(F.max(F.struct("n", "place", "value")).alias("best")).select("row", "label", F.xxhash64("best.place", "best.value").alias("family"))
    # as many rows as labelled documents: one for each id and label, unless ids repeat
    families = written(families, "families")
    families = families.join(F.broadcast(families.groupBy("family", "label").agg(F.count(F.lit(1)).alias("texts"))), ["family", "label"])
    of = families.select("row", (2 * F.pmod("family", F.lit(FOLDS)) + F.col("label")).cast("int").alias("kind"), F.expr(f"{UNIT} div texts").alias("units"))
    return texts.select("row", "text").join(bounded_broadcast(of, 2 * most), "row").select("text", "kind", "units")


def learned(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """The model of labelled rows; counts of entries are summed over the cluster, and the strongest entries come to the driver."""
    rows, n_kinds = labelled(docs, labels, most), 2 * FOLDS
    kinds = np.zeros(n_kinds)
    for r in rows.groupBy("kind").agg(F.sum("units").alias("units")).collect():
        kinds[r.kind] = r.units / UNIT
    if not kinds.any():
        return Model(Lexicon({}), PRIOR)
    columns = [f"k{k}" for k in range(n_kinds)] + ["words", "after"]

    def count(batches):
        for batch in batches:
            texts, kind, units = text_column(batch), np.asarray(batch.column("kind"), dtype=np.int64), np.asarray(batch.column("units"))
            for i, j in slices(texts, LEARN_BYTES):
                names, counts = entry_counts(texts.slice(i, j - i), kind[i:j], units[i:j], n_kinds)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array(counts[:, k]) for k in range(n_kinds + 2))], ["entry", *columns])

    counted = rows.mapInArrow(count, ", ".join(["entry string", *(f"{c} long" for c in columns)])).groupBy("entry").agg(*(F.sum(c).alias(c) for c in columns))
    toxic, clean = float(kinds[1::2].sum()), float(kinds[0::2].sum())
    a, b = (sum(F.col(f"k{k}") for k in range(y, n_kinds, 2)) / UNIT for y in (1, 0))
    # entries below this share have less than LEAST_ODDS in every fold's lexicon, but for chance
    counted = counted.withColumn("a", a).withColumn("b", b).filter((F.col("a") >= LEAST_DOCS) & (F.col("a") * clean > F.col("b") * toxic))
    strength = F.col("a") * F.log((F.col("a") * (toxic + clean)) / ((F.col("a") + F.col("b")) * toxic))
    strongest = counted.orderBy(strength.desc(), "entry").limit(MOST_ENTRIES).select("entry", *columns).toArrow()
    names = strongest.column("entry").to_pylist()
    counts = np.stack([np.asarray(strongest.column(c), dtype=np.int64) for c in columns], axis=1) / UNIT if names else np.zeros((0, n_kinds + 2))
    by_fold = counts[:, :n_kinds].reshape(-1, FOLDS, 2)
    every, of_fold = by_fold.sum(1), kinds.reshape(FOLDS, 2)
    others = [lexicon_of(names, every - by_fold[:, f], counts[:, n_kinds:], of_fold.sum(0) - of_fold[f]) for f in range(FOLDS)]
    seen_columns = [*EVENTS, "length"]

    def seen(batches):
        for batch in batches:
            texts, kind = text_column(batch), np.asarray(batch.column("kind"), dtype=np.int64)
            totals = np.zeros((len(kind), len(seen_columns)))
            for f in np.unique(kind // 2).tolist():
                at = np.flatnonzero(kind // 2 == f)
                totals[at] = events(texts.take(pa.array(at)), others[f])
            yield pa.RecordBatch.from_arrays([pa.array(kind % 2, pa.int32()), batch.column("units"), *(pa.array(totals[:, k]) for k in range(len(seen_columns)))], ["label", "units", *seen_columns])

    # at most ``most`` rows of nine numbers for distinct ids; rows alike come as one
    found = rows.mapInArrow(seen, ", ".join(["label int", "units long", *(f"{e} double" for e in seen_columns)])).groupBy("label", *seen_columns).agg(F.sum("units").alias("units")).orderBy("label", *seen_columns).toArrow()
    totals = np.stack([np.asarray(found.column(e)) for e in seen_columns], axis=1)
    weights = fit(totals, np.asarray(found.column("label")), np.asarray(found.column("units")) / UNIT)
    return Model(lexicon_of(names, every, counts[:, n_kinds:], of_fold.sum(0)), weights)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most: int = MOST_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. Learning runs when this is called."""
    model = learned(docs, labels, most)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(text_column(batch)))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def filtered(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most: int = MOST_LABELLED) -> DataFrame:
    """The documents that aren't predicted toxic, row by row, with the columns of ``docs``. Learning runs when this is called."""
    model, text = learned(docs, labels, most), f"c{docs.columns.index('text')}"
    # columns by place: a name with a dot in it can't go into mapInArrow
    rows = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(text_column(batch, text)))], [*batch.schema.names, "score"])

    marked = rows.mapInArrow(run, rows.withColumn("score", F.lit(0.0)).schema)
    return marked.filter(F.col("score") < threshold).drop("score").toDF(*docs.columns)


def op9_query(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
