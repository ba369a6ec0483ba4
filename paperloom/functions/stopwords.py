"""The default stop-word list: the English one that Spark ML ships.

Every function that removes stop words takes the list as a parameter, so another list
(a longer one, another language) can be passed instead.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile

import pyspark


@functools.cache
def english_stop_words() -> tuple[str, ...]:
    """Same words as ``StopWordsRemover.loadDefaultStopWords("english")``, read without a JVM."""
    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    jars = glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar"))
    if not jars:
        from pyspark.ml.feature import StopWordsRemover

        return tuple(StopWordsRemover.loadDefaultStopWords("english"))
    with zipfile.ZipFile(jars[0]) as jar:
        text = jar.read("org/apache/spark/ml/feature/stopwords/english.txt").decode("utf-8")
    return tuple(line for line in text.split("\n") if line)
