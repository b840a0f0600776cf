"""Each corpus query without SQL names the test that compares it with a plain version."""

import importlib

import __spark_entry__ as driver

PLAIN = {
    "op1_token_counts": ("test_words_and_counts", "test_token_counts_of_documents_equal_brute_force"),
    "op2_license_scan": ("test_words_and_counts", "test_notices_are_those_of_alignment_at_every_place"),
    "op3_quality_rules": ("test_words_and_counts", "test_base_counts_and_verdicts_on_documents"),
    "op6_pii": ("test_similar_and_private", "test_documents_spans_digests_and_counts"),
    "op7_lm_score": ("test_models_and_files", "test_scores_equal_brute_force"),
    "op8_quality_classifier": ("test_models_and_files", "test_classifier_equals_a_plain_reading_of_each_text"),
    "op10_packing": ("test_models_and_files", "test_documents_come_back_from_their_pieces"),
    "op11_best_two_fit": ("test_two_fit", "test_documents_come_back_and_few_sequences_are_used"),
    "op12_whitening": ("test_whitening", "test_whole_table"),
    "pipeline": ("test_pipeline", "test_stages_equal_brute_force"),
}


def test_every_query_without_sql_has_a_plain_version():
    corpus = {name for name in driver.queries() if name.startswith("op") or name == "pipeline"}
    assert corpus - set(driver.oracle_sql()) == set(PLAIN)
    for module, name in PLAIN.values():
        assert callable(getattr(importlib.import_module(module), name))
