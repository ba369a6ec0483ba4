"""The operators as Spark ML stages: transformers, estimators and evaluators."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
    MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..functions.vectors import argmax_label
from ..session import materialize
from . import cleaning, evaluate, metadata, terms


class _PartsWriter(MLWriter):
    """Writes a stage's parameters, its own settings and the parts it is made of."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        settings = {"settings": self.stage.settings()}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata=settings)
        self.stage.save_parts(path)


class _PartsReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind.from_parts(self.sparkSession, path, metadata["settings"])
        stage._resetUid(metadata["uid"])
        return stage


class _WithParts(MLWritable, MLReadable):
    """A stage that is saved as what ``save_parts`` writes and ``from_parts`` reads."""

    def settings(self) -> dict:
        return {}

    def write(self) -> MLWriter:
        return _PartsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _PartsReader(cls)


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    pass


class MissingFiller(_Stage):
    def _transform(self, df: DataFrame) -> DataFrame:
        return cleaning.fill_missing(df)


class AuthorNormalizer(_Stage):
    def _transform(self, df: DataFrame) -> DataFrame:
        return cleaning.normalize_authors(df)


class TextCleaner(_Stage):
    def _transform(self, df: DataFrame) -> DataFrame:
        return cleaning.clean_texts(df)


def cleaning_stages() -> Pipeline:
    return Pipeline(stages=[MissingFiller(), AuthorNormalizer(), TextCleaner()])


class TfidfBlock(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """TF-IDF of one text column as a sparse vector of at most ``maxFeatures`` entries.

    ``fit`` counts terms in one shuffle. The fitted stages are Spark's own and narrow: a count
    vectorizer with the found vocabulary, a product with the idf values, a normalizer.
    """

    inputCol = Param(Params._dummy(), "inputCol", "text column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "vocabulary limit", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "fewest records of a term", TypeConverters.toInt)
    maxDF = Param(Params._dummy(), "maxDF", "largest share of records", TypeConverters.toFloat)
    stopWords = Param(Params._dummy(), "stopWords", "words left out", TypeConverters.toListString)
    bigrams = Param(Params._dummy(), "bigrams", "also pairs of words", TypeConverters.toBoolean)
    lastNames = Param(Params._dummy(), "lastNames", "last names of authors", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, maxFeatures=8000, minDF=2, maxDF=0.9,
                 stopWords=None, bigrams=True, lastNames=False):
        super().__init__()
        self._setDefault(maxFeatures=8000, minDF=2, maxDF=0.9, stopWords=[], bigrams=True, lastNames=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _get(self, name: str):
        return self.getOrDefault(self.getParam(name))

    def _fit(self, df: DataFrame) -> PipelineModel:
        source, out = self._get("inputCol"), self._get("outputCol")
        text = T.author_last_names(source) if self._get("lastNames") else F.col(source)
        stop, bigrams = self._get("stopWords"), self._get("bigrams")
        seen = df.select(F.inline(T.term_counts(T.analyze(text, stop, bigrams))))
        limit = self._get("maxFeatures")
        vocab = terms.vocabulary(df, seen, self._get("minDF"), self._get("maxDF"), limit)
        # At most ``maxFeatures`` rows come to the driver: they become the model.
        rows = vocab.select("term", "idf").orderBy("term").collect()
        words = [r["term"] for r in rows] or [""]
        idf = [r["idf"] for r in rows] or [1.0]
        tokens = TermTokens(inputCol=source, outputCol=f"{out}_terms", stopWords=stop,
                            bigrams=bigrams, lastNames=self._get("lastNames"))
        counts = CountVectorizerModel.from_vocabulary(
            words, inputCol=f"{out}_terms", outputCol=f"{out}_tf"
        )
        scaled = ElementwiseProduct(
            scalingVec=Vectors.dense(idf), inputCol=f"{out}_tf", outputCol=f"{out}_raw"
        )
        unit = Normalizer(p=2.0, inputCol=f"{out}_raw", outputCol=out)
        helpers = DropColumns(columns=[f"{out}_terms", f"{out}_tf", f"{out}_raw"])
        return PipelineModel([tokens, counts, scaled, unit, helpers])


class TermTokens(_Stage):
    """Text to the array of terms."""

    inputCol = Param(Params._dummy(), "inputCol", "text column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "array column", TypeConverters.toString)
    stopWords = Param(Params._dummy(), "stopWords", "words left out", TypeConverters.toListString)
    bigrams = Param(Params._dummy(), "bigrams", "also pairs of words", TypeConverters.toBoolean)
    lastNames = Param(Params._dummy(), "lastNames", "last names of authors", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, stopWords=None, bigrams=True, lastNames=False):
        super().__init__()
        self._setDefault(stopWords=[], bigrams=True, lastNames=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        source = self.getOrDefault(self.inputCol)
        text = T.author_last_names(source) if self.getOrDefault(self.lastNames) else F.col(source)
        analyzed = T.analyze(text, self.getOrDefault(self.stopWords), self.getOrDefault(self.bigrams))
        return df.withColumn(self.getOrDefault(self.outputCol), analyzed)


class DropColumns(_Stage):
    columns = Param(Params._dummy(), "columns", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault(self.columns))


class NonNegative(_Stage):
    """Cut negative vector entries to 0: a held-out value may lie below the training minimum."""

    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        values = vector_to_array(self.getOrDefault(self.inputCol))
        cut = F.transform(values, lambda v: F.greatest(v, F.lit(0.0)))
        return df.withColumn(self.getOrDefault(self.outputCol), array_to_vector(cut))


class BoostedTrees(Estimator, _WithParts):
    """Gradient-boosted trees for zero-based labels: one binary booster per label.

    ``held`` names a boolean column; those rows stop the boosting when the error no longer
    falls by more than the tolerance. The boosters are fitted side by side.
    """

    def __init__(self, booster: GBTClassifier, labels: int, held: str | None = None):
        super().__init__()
        self.booster, self.labels, self.held = booster, labels, held

    def settings(self) -> dict:
        return {"labels": self.labels, "held": self.held}

    def save_parts(self, folder: str) -> None:
        self.booster.write().overwrite().save(f"{folder}/booster")

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> BoostedTrees:
        return cls(GBTClassifier.load(f"{folder}/booster"), **settings)

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        columns = ["features", "target"] + ([self.held] if self.held else [])
        rows = materialize(df.select(*columns), "boosting")

        def fit(k: int) -> Model:
            binary = rows.withColumn("binary", (F.col("target") == k).cast("double"))
            return self.booster.copy({self.booster.labelCol: "binary"}).fit(binary)

        with ThreadPool(self.labels) as pool:
            return BoostedTreesModel(pool.map(inheritable_thread_target(df.sparkSession)(fit), range(self.labels)))


class BoostedTreesModel(Model, _WithParts):
    """Adds ``probability`` (shares of the positive scores) and ``prediction``."""

    def __init__(self, boosters: list):
        super().__init__()
        self.boosters = boosters

    def settings(self) -> dict:
        return {"n": len(self.boosters)}

    def save_parts(self, folder: str) -> None:
        for k, booster in enumerate(self.boosters):
            booster.write().overwrite().save(f"{folder}/booster_{k}")

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> BoostedTreesModel:
        return cls([GBTClassificationModel.load(f"{folder}/booster_{k}") for k in range(settings["n"])])

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for k, model in enumerate(self.boosters):
            scored = model.transform(out)
            positive = vector_to_array("probability")[1].alias(f"_p{k}")
            out = scored.select(*out.columns, positive)
        names = [f"_p{k}" for k in range(len(self.boosters))]
        total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
        shares = F.array(*[F.col(n) / total for n in names])
        out = out.withColumn("_shares", shares).withColumns({
            "probability": array_to_vector("_shares"),
            "prediction": argmax_label("_shares").cast("double"),
        })
        return out.drop("_shares", *names)


class MetadataFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """The eight metadata features as a dense vector column ``metadata``."""

    def _fit(self, df: DataFrame) -> MetadataFeaturesModel:
        return MetadataFeaturesModel(metadata.fit_metadata(df))


class MetadataFeaturesModel(Model, _WithParts):
    """Holds the learned tables as DataFrames, so they may be larger than the driver."""

    COLUMNS = [*metadata.SCALED, *metadata.FLAGS]
    TABLES = ("venues", "frequency", "stats")

    def __init__(self, state: metadata.MetadataState):
        super().__init__()
        self.state = state

    def _transform(self, df: DataFrame) -> DataFrame:
        features = metadata.metadata_features(df, self.state)
        assembler = VectorAssembler(inputCols=self.COLUMNS, outputCol="metadata")
        return df.join(assembler.transform(features).select("id", "metadata"), "id")

    def save_parts(self, folder: str) -> None:
        for name in self.TABLES:
            getattr(self.state, name).write.mode("overwrite").parquet(f"{folder}/{name}")

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> MetadataFeaturesModel:
        return cls(metadata.MetadataState(*[spark.read.parquet(f"{folder}/{name}") for name in cls.TABLES]))


def feature_union(stop_words, title: int = 3000, abstract: int = 8000, author: int = 1500) -> Pipeline:
    """Text and metadata features in one vector: fit on train, apply to any split."""
    words = list(stop_words)
    return Pipeline(stages=[
        TfidfBlock(inputCol="title", outputCol="title_tfidf", maxFeatures=title, stopWords=words),
        TfidfBlock(inputCol="abstract", outputCol="abstract_tfidf", maxFeatures=abstract, stopWords=words),
        TfidfBlock(inputCol="authors", outputCol="author_tfidf", maxFeatures=author, minDF=1,
                   maxDF=1.0, bigrams=False, lastNames=True),
        MetadataFeatures(),
        VectorAssembler(
            inputCols=["title_tfidf", "abstract_tfidf", "author_tfidf", "metadata"],
            outputCol="features",
        ),
    ])


class MacroF1Evaluator(Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Macro-F1 over zero-based labels."""

    @keyword_only
    def __init__(self, *, labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _score(self, label, prediction):
        return evaluate.macro_f1(label, prediction)

    def _evaluate(self, df: DataFrame) -> float:
        label, prediction = F.col(self.getLabelCol()) + 1, F.col(self.getPredictionCol()) + 1
        return df.agg(self._score(label, prediction)).first()[0] or 0.0

    def isLargerBetter(self) -> bool:
        return True


class ObjectiveEvaluator(MacroF1Evaluator):
    """Weighted kappa and macro-F1 in one number."""

    def _score(self, label, prediction):
        return evaluate.combined_objective(label, prediction)


class KappaEvaluator(MacroF1Evaluator):
    def _score(self, label, prediction):
        return evaluate.qwk(label, prediction)
