"""The bidirectional preparation job (P1) as stages with a manifest.

Row-local stages are kept by language and split, models come from the training
split, composed sets by split: a run that finds its inputs unchanged computes
nothing, a changed split recomputes its own stages only (a changed training
split also what is learned from it), and a run after a failure goes on with
what is there. Codes and dictionary are learned once and reused by later steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linea.functions import text as T
from linea.operators import collocations as CO
from linea.operators import compose as C
from linea.operators import counts as N
from linea.operators import subword as SW
from linea.operators import truecase as TC
from linea.operators import vocab as V
from linea.sources.stages import Stage, Stages, content_fingerprints
from linea.sources.text import bind_strict

SPLITS, LANGS = ("train", "valid", "test"), ("en", "vi")
LINE = ("line_no",)


class Preparation:
    """Stages of one corpus ``split, lang, line_no, text``; each method gives a stage, built if need be."""

    def __init__(self, stages: Stages, corpus: DataFrame, normalize_form: str = "NFKD", num_merges: int = 5000):
        self.stages, self.corpus = stages, corpus
        self.form, self.num_merges = normalize_form, num_merges
        self.source = content_fingerprints(corpus.select("split", "lang", "line_no", "text"), ["split", "lang"])

    def _lines(self, name: str, inputs: list, build) -> Stage:
        return self.stages.stage(name, inputs, build, bucket_by=LINE)

    def tokens(self, lang: str, split: str) -> Stage:
        """T1 and T3 (English) or 13a (Vietnamese): ``line_no, tokens``."""
        def build():
            part = self.corpus.where((F.col("lang") == lang) & (F.col("split") == split))
            text = T.unicode_normalize("text", self.form)
            part = part.select("line_no", text.alias("text"))
            rules = T.tokenize_13a("text") if lang == "vi" else T.tokenize_en("text")
            return part.select("line_no", F.filter(F.split(rules, " "), lambda x: x != "").alias("tokens"))

        return self._lines(f"tokens/{lang}/{split}", [self.source.get((split, lang)), self.form], build)

    def lexicon(self) -> Stage:
        """T4: Vietnamese compounds mined on the training split."""
        train = self.tokens("vi", "train")
        return self.stages.stage("lexicon/vi", [train], lambda: CO.mine(train.frame, "tokens"))

    def words(self, lang: str, split: str) -> Stage:
        """Tokens, Vietnamese compounds joined."""
        plain = self.tokens(lang, split)
        if lang != "vi":
            return plain
        lexicon = self.lexicon()

        def build():
            joined = CO.segment(plain.frame, lexicon.frame, line="line_no")
            return joined.select("line_no", F.filter(F.split("text", " "), lambda x: x != "").alias("tokens"))

        return self._lines(f"words/{lang}/{split}", [plain, lexicon], build)

    def forms(self, lang: str) -> Stage:
        """M1: surface forms of the training split."""
        train = self.words(lang, "train")
        return self.stages.stage(f"forms/{lang}", [train], lambda: TC.surface_forms(train.frame, "line_no"))

    def cased(self, lang: str, split: str) -> Stage:
        """M2: ``line_no, text``."""
        words, forms = self.words(lang, split), self.forms(lang)

        def build():
            out = TC.apply(words.frame, TC.best_forms(forms.frame), forms.frame.select("w"), line="line_no")
            return out.select("line_no", F.array_join(F.coalesce("tokens", F.array().cast("array<string>")), " ").alias("text"))

        return self._lines(f"cased/{lang}/{split}", [words, forms], build)

    def pairs(self, split: str) -> DataFrame:
        """``line_no, en, vi``, bound without a shuffle: both sides are bucketed by line."""
        a, b = (self.cased(lang, split).frame.select("line_no", F.col("text").alias(lang)) for lang in LANGS)
        return bind_strict(a, b, ["line_no"], f"{split}: en and vi")

    def sets(self, split: str, step: int = 0, synthetic: DataFrame | None = None) -> Stage:
        """C3 (step 0) or C4 around step k-1 (train; ``synthetic``: line_no, syn_en, syn_vi); valid and test are step 0's."""
        if step == 0 or split != "train":
            sides = [self.cased(lang, split) for lang in LANGS]
            return self._lines(f"step0/sets/{split}", sides, lambda: C.build_bidirectional(self.pairs(split)))
        prev = self.stages.read(f"step{step - 1}/sets/train")
        made = [self.cased(lang, "train") for lang in LANGS]
        said = content_fingerprints(synthetic.withColumn("__all", F.lit(0)), ["__all"])
        before = self.stages._newest(f"step{step - 1}/sets/train")["made_from"]

        def build():
            par = bind_strict(self.pairs("train"), synthetic, ["line_no"], "genuine and synthetic lines")
            return C.build_step(step, par, prev)

        return self._lines(f"step{step}/sets/train", [*made, list(said.values()), before], build)

    def codes(self) -> tuple[Stage, Stage]:
        """M4, learned once from step 0's training set: merges, and the word types in the merged symbols."""
        train = self.sets("train")
        learned: list = []

        def learn():
            if not learned:
                both = [train.frame.select(F.split(c, " ").alias("tokens")) for c in ("src", "tgt")]
                learned.append(SW.learn_types(SW.word_types(both[0].unionByName(both[1])), self.num_merges))
            return learned[0]

        types = self.stages.stage("codes/types", [train, self.num_merges], lambda: learn()[1], once=True)
        merges = self.stages.stage("codes/merges", [types], lambda: SW.merges_frame(self.stages.spark, learn()[0]), once=True)
        return merges, types

    def subword(self, split: str, step: int = 0, synthetic: DataFrame | None = None) -> Stage:
        """``line_no, src, tgt`` in subwords, sources tagged."""
        sets = self.sets(split, step, synthetic)
        merges, types = self.codes()

        def build():
            ranked = [(r["a"], r["b"], r["cnt"]) for r in merges.frame.orderBy("rank").collect()]  # at most num_merges
            sub = SW.segment(sets.frame, {"src": "src", "tgt": "tgt"}, ranked, SW.subwords(types.frame))
            return C.tag_directions(sub.withColumn("split", F.lit(split)), step, split, text="src").select("line_no", "src", "tgt")

        return self._lines(f"step{step}/subword/{split}", [sets, merges], build)

    def dictionary(self) -> Stage:
        """M7: the joint dictionary of step 0's training set, built once."""
        train = self.subword("train")

        def build():
            both = [train.frame.select(F.split(c, " ").alias("tokens")) for c in ("src", "tgt")]
            return V.build_dictionary(both[0].unionByName(both[1]), pad_to_multiple=8)

        return self.stages.stage("dictionary", [train], build, once=True)

    def step_counts(self, step: int = 0, synthetic: DataFrame | None = None) -> Stage:
        """``token, cnt`` of a step's training set: step k counts its own lines only and adds step k-1's table."""
        sets = self.sets("train", step, synthetic)
        sides = lambda df: df.select(F.explode(F.array("src", "tgt")).alias("s")).select(F.split("s", " ").alias("tokens"))
        if step == 0:
            return self.stages.stage("step0/counts", [sets], lambda: V.token_counts(sides(sets.frame)))
        before = self.step_counts(step - 1, synthetic)
        # of every 2(k+1) lines, the first of each half is new
        own = sets.frame.where(F.pmod("line_no", F.lit(step + 1)) == 0)
        return self.stages.stage(f"step{step}/counts", [sets, before], lambda: N.merged([before.frame, V.token_counts(sides(own))]))

    def encoded(self, split: str, step: int = 0, synthetic: DataFrame | None = None) -> Stage:
        """M8: ``line_no, src_ids, tgt_ids``."""
        sub, dictionary = self.subword(split, step, synthetic), self.dictionary()

        def build():
            ids = [V.encode(sub.frame.select("line_no", F.split(c, " ").alias("tokens")), dictionary.frame, line="line_no")
                   .select("line_no", F.col("ids").alias(f"{c}_ids")) for c in ("src", "tgt")]
            return ids[0].join(ids[1], "line_no")

        return self._lines(f"step{step}/encoded/{split}", [sub, dictionary], build)

    def translation_input(self, lang: str, split: str) -> Stage:
        """P5: step 0's cased lines in subwords, tagged by language; only if absent."""
        cased = self.cased(lang, split)
        merges, types = self.codes()

        def build():
            ranked = [(r["a"], r["b"], r["cnt"]) for r in merges.frame.orderBy("rank").collect()]
            sub = SW.segment(cased.frame, {"text": "text"}, ranked, SW.subwords(types.frame))
            tag = F.lit(T.TAG_E2V if lang == "en" else T.TAG_V2E)
            return sub.select("line_no", T.tag_constant("text", tag).alias("text"))

        return self.stages.stage(f"translation/{lang}/{split}", [cased, merges], build, bucket_by=LINE, once=True)

    def all_sets(self, step: int = 0, synthetic: DataFrame | None = None) -> DataFrame:
        """``split, line_no, src, tgt`` of a step."""
        parts = [self.sets(s, step, synthetic).frame.select(F.lit(s).alias("split"), "line_no", "src", "tgt") for s in SPLITS]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])
