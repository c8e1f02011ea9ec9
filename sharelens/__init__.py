"""Analytics over product-share logs: who shared which item with whom, and when.

Every operator is a plain function from DataFrames to a DataFrame.  Shares carry
``inviter_id, item_id, voter_id, ts``; users ``user_id, user_gender, user_age,
user_level``; items ``item_id, cate_id, cate_level1_id, brand_id, shop_id``;
queries are shares without the voter plus a ``triple_id``.
"""
