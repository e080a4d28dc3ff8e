from stepforge.operators import annotate as O


def test_each_strategy_parses_a_response_once(spark):
    rows = [("a", "groq", "no json here"), ("a", "google", '```json\n{"reasoning": "a long enough reasoning text", "intent": "go"}\n```'),
            ("b", "groq", 'x {"reasoning": "another long enough reasoning"} y'), ("c", "groq", '{"reasoning": "cut but long enough, quite", oops'),
            ("d", "groq", None)]
    chosen = O.choose_response(spark.createDataFrame(rows, "sample_id string, provider string, raw_response string"), 10)
    assert chosen._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 3
    got = {r.sample_id: (r.provider, r.llm_reasoning, r.llm_intent) for r in chosen.collect()}
    assert got == {
        "a": ("google", "a long enough reasoning text", "go"), "b": ("groq", "another long enough reasoning", ""),
        "c": ("groq", "cut but long enough, quite", ""),
    }
