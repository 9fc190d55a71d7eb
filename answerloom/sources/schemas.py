"""Explicit schemas; nothing is ever inferred from data.

``gold`` and ids stay text: "9" must not become 9.0 because a column happens
to hold numbers and blanks.
"""

# Field names and types of the exchanged files, in file order.
PROBLEM_SCHEMA = """
    problem STRING, solution STRING, answer STRING,
    subject STRING, level STRING, unique_id STRING
"""
RUN_SCHEMA = """
    task STRING, model STRING, method STRING, alpha DOUBLE, B INT, n_mcmc INT,
    temperature DOUBLE, top_p DOUBLE, seed INT, shard_id INT, example_id STRING,
    prompt STRING, completion STRING, gold STRING, pred STRING, correct INT,
    accept_rate DOUBLE, num_tokens_generated INT, base_loglik_sum DOUBLE,
    base_loglik_avg DOUBLE, avg_entropy DOUBLE
"""
GRADED_FIELDS = "pred_eval STRING, correct_eval INT"
PER_EXAMPLE_SCHEMA = """
    example_id STRING, seed INT, method STRING, correct INT, gold STRING, pred STRING
"""
SCORES_SCHEMA = """
    n BIGINT, accuracy DOUBLE,
    accuracy_by_method MAP<STRING, DOUBLE>, accuracy_by_seed MAP<STRING, DOUBLE>
"""
