"""Training-data operators: packing, language-model scoring, licence scan,
chat formatting, quality rules, token files, sharding, HTML extraction,
benchmark decontamination, n-gram Jaccard join, fill-in-the-middle texts, vector
codes and mixing of sources.

Nothing else in the package imports this subpackage; ``queries`` registers the
thin ``opN_*`` queries and ``sql`` holds their DuckDB texts.
"""
