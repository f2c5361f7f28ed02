"""The operators that compute in Python, on workers that cannot import the package."""
from worker_runs import run


def test_training_data_operators(tmp_path):
    assert run("""
from gridspark.llm import embeddings, near_copies, ranked, secrets, trie
e = spark.createDataFrame([(i, 0, [1.0, 0.01 * i]) for i in range(6)], "vec_id long, label int, embedding array<double>")
d = spark.createDataFrame([(i, "one two three four five six seven token = abcdefghijklmnop") for i in range(3)], "doc_id long, text string")
q = spark.createDataFrame([(0, "three")], "item_id long, text string")
c = spark.createDataFrame([(5, 0, "u", "x"), (6, 0, "u", "y")], "conv_id long, turn int, role string, text string")
print(embeddings.near_duplicates(e).count(), near_copies.without_near_copies(d).count(), ranked.search(d, q).count(), secrets.secrets_found(d).count(), trie.prefix_trie(*trie.rebuilt(trie.sequences(c))).count() > 0)
""", tmp_path) == "6 1 3 3 True"
