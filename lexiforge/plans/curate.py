"""The curation run: extract, generate, evaluate (with rescue and regeneration), split, export.

Each stage writes a committed table under output_dir; a stage whose table is committed is skipped unless it is forced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import cache_key
from ..operators import chunk, dedup, export, generate, regenerate, report, rescue, score, split
from ..sources import sinks
from ..sources.arrivals import Documents
from ..sources.storage import exists, remove, written
from ..streaming.generation import Generation
from .monitor import Monitor, observed
from .settings import Settings

STAGES = ("extract", "generate", "evaluate", "split", "export")


class Curation:
    def __init__(self, spark: SparkSession, settings: Settings, provider=None):
        """provider: one, or a list with one for each key."""
        self.spark, self.settings = spark, settings
        given = provider or generate.TemplateProvider()
        self.providers = list(given) if isinstance(given, (list, tuple)) else [given]
        self.calls = settings.calls(len(self.providers))
        self.out = settings.resolved("general.output_dir")
        self.cache = generate.CacheTable(spark, self.path("cache"))
        self.monitor = Monitor(spark, self.out, self.out)
        self.seen: dict[str, int] = {}

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def documents(self) -> Documents:
        return Documents(self.spark, self.path("extract"), self.settings.resolved("general.input_dir"))

    def done(self, name: str) -> bool:
        return self.documents().exists() if name == "extract" else exists(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        if name == "extract":
            return self.documents().documents().filter("error is null").drop("error").withColumn("seq", F.xxhash64("file_path"))
        return self.spark.read.parquet(self.path(name))

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes a table; its counters are taken by the write."""
        seen = observed(df, lambda x: x.write.mode("overwrite").parquet(self.path(name)))
        if name in STAGES:
            self.seen = seen
        return self.read(name)

    def run(self, steps: list[str] | None = None, force: bool = False) -> list[str]:
        """Runs the named stages, or all that are not done; returns those that ran. Unknown names are skipped."""
        ran = []
        for name in STAGES:
            if steps is not None and name not in steps:
                continue
            if steps is None and not force and self.done(name):
                continue
            self.monitor.start(name)
            self.seen = {}
            try:
                getattr(self, name)()
            except Exception as e:
                self.monitor.record_error(e, name, "critical")
                self.monitor.end(name, {}, failed=True)
                raise
            self.monitor.end(name, self.seen)
            ran.append(name)
        return ran

    def resume(self) -> list[str]:
        return self.run()

    def extract(self) -> DataFrame:
        """Reads files that are new or have changed since the last time."""
        self.seen = {"rows": self.documents().update()}
        return self.read("extract")

    def chunks(self) -> DataFrame:
        """Chunks of all documents; tables with huge ones, by the lengths that were noted when they were read, are cut in parts."""
        docs = self.read("extract")
        longest = docs.agg(F.max("char_count")).first()[0]
        cut = chunk.chunked_parts if (longest or 0) > chunk.HUGE else chunk.chunked
        return cut(docs, size=self.settings.get("processing.chunk_size"), overlap=self.settings.get("processing.chunk_overlap"))

    def generate(self) -> DataFrame:
        """Pairs of all chunks. What was answered before a stop is not asked again: the folder of a generation goes only when its tables are committed."""
        get, folder = self.settings.get, self.path("generation")
        template, model = get("qa_generation.prompt_template"), self.providers[0].name
        cache = self.cache if get("cache.enabled") else None
        work = Generation(self.spark, folder, self.providers, template, model, cache, get("cache.ttl_days"), get("qa_generation.num_qa"), get("processing.checkpoint_interval", 1), **self.calls)
        with self.monitor.listening("generate"):
            pairs, failed, _ = generate.outcome(work.run(self.chunks(), "generate"), model)
        failed = self.save(failed, "failed_chunks")
        made = self.save(self.with_seq(pairs), "generate")
        sinks.write_generated(made, failed, self.path("json"))
        remove(self.spark, folder)
        return made

    def generate_again(self, weak: DataFrame, to: str = "regenerated") -> DataFrame:
        """New pairs of weak chunks, whose old answers leave the cache."""
        get = self.settings.get
        template, model = get("qa_generation.prompt_template"), self.providers[0].name
        some = regenerate.only_chunks(self.chunks(), weak)
        self.cache.drop_keys(some.select(cache_key("content", F.lit(template), F.lit(model)).alias("cache_key")))
        pairs, failed, new = generate.generated(some, self.providers, template, model, None, get("cache.ttl_days"), num_qa=get("qa_generation.num_qa"), **self.calls)
        self.cache.append(new)
        failed = self.save(failed, "failed_again")
        made = self.save(self.with_seq(pairs), to)
        sinks.write_generated(made, failed, self.path("json/regenerated"))
        return made

    @staticmethod
    def with_seq(pairs: DataFrame) -> DataFrame:
        """seq: document, chunk and place as a text that sorts like them; no two rows share one."""
        return pairs.withColumn("seq", F.concat_ws("|", F.coalesce("source_doc", F.lit("")), F.lpad(F.col("chunk_id").cast("string"), 10, "0"), F.lpad(F.col("place").cast("string"), 6, "0")))

    def retry_failed(self) -> DataFrame:
        """Asks again for failed chunks only and adds what comes to the pairs."""
        get = self.settings.get
        pairs, failed, new = generate.generated(self.read("failed_chunks").drop("error"), self.providers, get("qa_generation.prompt_template"), self.providers[0].name, num_qa=get("qa_generation.num_qa"), **self.calls)
        self.cache.append(new)
        both = written(self.read("generate").unionByName(self.with_seq(pairs), allowMissingColumns=True), "retried")
        failed = written(failed, "failed")
        self.save(failed, "failed_chunks")
        return self.save(both, "generate")

    def evaluate(self) -> DataFrame:
        """A bounded loop: score, route, rescue, and generate weak chunks again; each round is a written table."""
        get, rules = self.settings.get, self.settings.score_rules()
        docs, todo, kept = self.read("extract"), self.read("generate"), None
        twice, rescued, bad_still = [], [], []
        limits = {"min_good_rate": get("regenerate.min_good_rate"), "min_good_count": get("regenerate.min_good_count")}
        for k in range(get("quality.max_iterations")):
            unique, duplicates = dedup.dedup_pairs(todo)
            twice.append(written(duplicates, "duplicates"))
            scored = score.rule_score(unique, rules)
            labelled = self.judged(scored, rules)
            good, bad = labelled.filter("label = 'good'"), labelled.filter("label = 'bad'")
            fixed, still = (written(x, "rescue") for x in rescue.rescue(bad, docs))
            rescued.append(fixed)
            bad_still.append(still)
            now = good.unionByName(fixed.withColumn("label", F.lit("good")), allowMissingColumns=True).unionByName(still, allowMissingColumns=True)
            now = written(now, "evaluated")
            kept = now if kept is None else written(kept.unionByName(now, allowMissingColumns=True), "evaluated")
            if k + 1 == get("quality.max_iterations"):
                break
            weak = written(regenerate.chunks_to_regenerate(kept, **limits), "weak")
            sinks.write_regenerate_list(weak, self.path("json"))
            if weak.isEmpty():
                break
            todo = self.generate_again(weak)
            if todo.isEmpty():
                break
            redone = todo.select("source_doc", "chunk_id").distinct()
            kept = written(regenerate.without_chunks(kept, redone), "evaluated")
        every = lambda frames: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)  # noqa: E731  one for each round
        sinks.write_duplicates(every(twice), self.path("json"))
        sinks.write_rescued(every(rescued), every(bad_still), self.path("json"))
        sinks.write_evaluated(kept, self.path("json"))
        near = dedup.near_pairs(kept.filter("label = 'good'"))
        self.save(report.full_report(kept, near), "report")
        return self.save(kept, "evaluate")

    def judged(self, scored: DataFrame, rules) -> DataFrame:
        """Rules alone, a model alone, or a model for what rules leave open."""
        mode = self.settings.get("quality.mode")
        template = self.settings.get("quality.prompt_template")
        by_rule = scored.withColumn("eval_method", F.lit("rule"))
        if mode == "llm":
            return score.routed(generate.judged(by_rule, self.providers, template, **self.calls), rules.min_score)
        if mode == "hybrid":
            placed = score.routed_hybrid(by_rule)
            open_ = score.routed(generate.judged(placed.filter("label = 'borderline'").drop("label"), self.providers, template, **self.calls), rules.min_score)
            return placed.filter("label <> 'borderline'").unionByName(open_)
        return score.routed(by_rule, rules.min_score)

    def split(self) -> DataFrame:
        get = self.settings.get
        good = self.read("evaluate").filter("label = 'good'")
        if get("filter.enabled"):
            good, removed = score.filter_low_quality(good)
            self.save(removed, "filtered")
        placed = self.save(split.split_by_document(good, get("output.train_ratio"), get("output.val_ratio"), get("output.seed")), "split")
        self.save(split.split_info(placed, ids=False), "split_info")
        self.save(split.split_documents(placed), "split_documents")
        self.save(split.leakage(placed), "leakage")
        return placed

    def rescued(self) -> DataFrame:
        """The rescued pairs of the last evaluation, of an earlier run too."""
        return sinks.read_rescued(self.spark, self.path("json"))

    def export(self) -> DataFrame:
        """The splits in the configured format. Without splits the good pairs are split by row at random, as earlier versions of the data were."""
        if not self.done("split"):
            good = self.read("evaluate").filter("label = 'good'")
            sinks.write_legacy(good, self.path("json"), self.settings.get("output.format", "chat"))
            return self.spark.read.json(f"{self.path('json')}/legacy_{self.settings.get('output.format', 'chat')}")
        structure = self.settings.get("output.structure", {})
        fields = structure.get("metadata_fields", [])
        out = export.formatted(self.read("split"), self.settings.get("output.format", "chat"), source="source" in fields, perspective="perspective" in fields, keep=("split",))
        export.write_splits(out, self.path("export"))
        final = self.save(export.merged(out), "dataset_final")
        sinks.write_final(final, self.path("json"), tuple(self.settings.get("output.formats")))
        return out

    def summary(self) -> DataFrame:
        return report.pipeline_summary(self.read("evaluate"))
