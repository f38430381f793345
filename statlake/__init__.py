"""statlake: a Spark-native analytics lakehouse for sports statistics and articles.

``sources`` read files and lake tables, ``functions`` hold column expressions,
``operators`` are DataFrame -> DataFrame building blocks, ``plans`` compose
them into the gold fact, features, models, registry, retrieval and marts, and
``streaming`` runs the ingest and upsert steps on file streams.
"""
