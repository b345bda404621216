from clickloom.operators import categories as C


def test_counts_use_every_list_of_a_row(make_actions):
    actions = make_actions([
        {"click_category_id": 1, "order_category_ids": "2,3", "pay_category_ids": "3"},
        {"order_category_ids": "2,2"},
        {"click_category_id": None},
        {},
    ])
    counts = {r.category_id: tuple(r)[1:] for r in C.full_counts(actions).collect()}
    assert counts == {1: (1, 0, 0), 2: (0, 3, 0), 3: (0, 1, 1)}
    assert {r.category_id for r in C.universe(actions).collect()} == {1, 2, 3}
    assert [tuple(r) for r in C.click_count(actions).collect()] == [(1, 1)]
    assert sorted(tuple(r) for r in C.order_count(actions).collect()) == [(2, 3), (3, 1)]
    assert [tuple(r) for r in C.pay_count(actions).collect()] == [(3, 1)]


def test_top_categories_by_three_keys_and_wide_counts(spark):
    counts = spark.createDataFrame(
        [(1, 5, 9, 0), (2, 5, 9, 1), (3, 5_000_000_000, 0, 0), (4, 1, 0, 0), (5, 5, 9, 1)],
        "category_id bigint, click_count bigint, order_count bigint, pay_count bigint")
    assert [r.category_id for r in C.top_categories(counts, 4).collect()] == [3, 2, 5, 1]


def test_sessions_rank_as_numbers(make_actions):
    rows = ([{"session_id": "nine", "click_category_id": 4}] * 9
            + [{"session_id": "ten", "click_category_id": 4}] * 10
            + [{"session_id": "one", "click_category_id": 8}])
    top = C.top_sessions(C.session_clicks(make_actions(rows)), k=1)
    assert sorted(tuple(r) for r in top.collect()) == [(4, "ten", 10), (8, "one", 1)]
