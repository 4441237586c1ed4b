from annualis.llm import secrets


def test_long_tokens_and_long_neighbours(llm):
    long, jwt = "a1B2" * 200, "eyJhbGciOiJIUzI1NiJ9." + "Zm9v1" * 30 + "." + "c2ln" * 12
    url, name = "https://h.example.com/" + "x" * 900, "user=" + "n" * 500
    cases = {1: f"user=alice {long} end", 2: f"user=alice {jwt}. end", 3: f"{url} {'.' * 300} {long}",
             4: f"{name} {long}", 5: f"{long} user=bob", 6: f"{url} {'.' * 500} {long}", 7: "a." * 20_000 + " user=bob",
             8: f"password={'p' * 900} user=carol"}
    df = llm.createDataFrame(list(cases.items()), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in secrets.report(secrets.scan_secrets(df)).collect()}
    assert spans[1] == f"weak_identifier:0:10,weak_secret:11:{11 + len(long)}"
    assert spans[2] == f"weak_identifier:0:10,weak_secret:11:{11 + len(jwt)}"
    at = len(cases[3]) - len(long)
    assert spans[3] == f"weak_secret:{at}:{at + len(long)}"
    assert spans[4] == f"weak_identifier:0:{len(name)},weak_secret:{len(name) + 1}:{len(cases[4])}"
    assert spans[5] == f"weak_secret:0:{len(long)},weak_identifier:{len(long) + 1}:{len(cases[5])}"
    assert spans[6] == spans[7] == ""
    assert spans[8] == f"assign:0:909,weak_identifier:910:{len(cases[8])}"
