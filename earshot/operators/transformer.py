"""Completions as a pipeline stage: columns for messages, output and error are parameters, and the stage can be saved."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.operators.completions import best_answers
from earshot.operators.skew import hot_keys, skew_join
from earshot.schemas import COMPLETIONS

ANSWER = [c for c in COMPLETIONS.names if c not in ("PromptId", "error")]


def message_key(messages: Column) -> Column:
    """Key of a prompt that is only known by its messages."""
    return F.sha2(F.to_json(messages), 256)


class CompletionTransformer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Attach stored completions to rows by their messages.

    ``messagesCol`` holds the messages; ``outputCol`` gets content, finish reasons, id and creation time, ``errorCol`` the error. Both are null for a
    prompt without a completion. ``completionsPath`` names the parquet folder of completions, whose PromptId is ``message_key`` of
    their messages; of several the newest usable one counts. Other columns, and repeated rows, stay.
    """

    messagesCol = Param(Params._dummy(), "messagesCol", "column with the messages of a prompt", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "column for the completion", TypeConverters.toString)
    errorCol = Param(Params._dummy(), "errorCol", "column for the error", TypeConverters.toString)
    completionsPath = Param(Params._dummy(), "completionsPath", "folder of stored completions", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, messagesCol: str = "Message", outputCol: str = "Completion", errorCol: str = "Error", completionsPath: str = ""):
        super().__init__()
        self._setDefault(messagesCol="Message", outputCol="Completion", errorCol="Error", completionsPath="")
        self._set(**self._input_kwargs)

    def setMessagesCol(self, value: str) -> CompletionTransformer:
        return self._set(messagesCol=value)

    def setOutputCol(self, value: str) -> CompletionTransformer:
        return self._set(outputCol=value)

    def setErrorCol(self, value: str) -> CompletionTransformer:
        return self._set(errorCol=value)

    def setCompletionsPath(self, value: str) -> CompletionTransformer:
        return self._set(completionsPath=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        messages, output, error = (self.getOrDefault(p) for p in (self.messagesCol, self.outputCol, self.errorCol))
        stored = dataset.sparkSession.read.schema(COMPLETIONS).parquet(self.getOrDefault(self.completionsPath))
        answers = best_answers(stored, F.col("created")).select(
            F.col("PromptId").alias("_prompt"), F.struct(*ANSWER).alias("_output"), F.col("error").alias("_error")
        )
        keyed = dataset.withColumn("_prompt", message_key(F.col(messages)))
        hot = hot_keys(keyed.select("_prompt"), ["_prompt"])
        rows = skew_join(keyed, answers, ["_prompt"], "left", None if len(dataset.columns) > 1 else [messages], hot)
        kept = [c for c in dataset.columns if c not in (output, error)]
        return rows.select(*kept, F.col("_output").alias(output), F.col("_error").alias(error))
