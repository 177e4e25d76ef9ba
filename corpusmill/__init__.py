"""corpusmill: a Spark-native engine for curating and analysing text corpora.

``functions``  column expressions (text classes, words, lines, lexicon counts)
``operators``  DataFrame -> DataFrame feature, decision, metric and model steps
``sources``    readers and writers
``plans``      whole runs: curation, training, evaluation
``streaming``  the same per-row steps over ``readStream``
``llm``        training-data operators; nothing above imports it
"""
