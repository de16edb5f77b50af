"""The queries of this subpackage: one ``opN_<name>`` per operator, and the pipeline."""

import corpus_pipeline
from essayspark.llm import queries

QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
ORACLE = queries.ORACLE | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
