"""The same results in plain SQL for DuckDB, written apart from the Spark plans."""

from __future__ import annotations

from storelens.sources.shop_views import PRODUCT_TEXTS, PRODUCTS, REVIEWS

P = f"products as ({PRODUCTS.format(part='part')})"
R = f"reviews as ({REVIEWS.format(lineitem='lineitem')})"
PT = f"texts as ({PRODUCT_TEXTS.format(part='part')})"

# The nested text as JSON; the generated values contain no quotes of their own.
NESTED = f"""{PT},
nested as (
  select asin, price, p_type, p_size, salesrank, categories, related,
    json_extract_string(replace(categories, '''', '"'), '$[0][0]') as top,
    json_extract_string(replace(categories, '''', '"'), '$[0][1]') as sub,
    from_json(json_extract(replace(related, '''', '"'), '$.also_viewed'), '["VARCHAR"]') as also_viewed,
    from_json(json_extract(replace(related, '''', '"'), '$.bought_together'), '["VARCHAR"]') as bought_together
  from texts),
mentions as (
  select unnest(also_viewed) as asin from nested
  union all
  select unnest(bought_together) from nested)"""

WORDS = r"""words as (
  select doc_id, list_filter(
    regexp_split_to_array(lower(text),
      '[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'),
    lambda word: word <> '') as words
  from documents)"""

RATINGS = f"""{P}, {R},
ratings as (select asin, avg(overall) as m, count(overall) as n from reviews group by asin),
rated as (
  select products.asin, ratings.m as "meanRating", ratings.n as "countRating"
  from products left join ratings on products.asin = ratings.asin)"""

VIEWED = f"""{NESTED},
listed as (select asin as product, unnest(also_viewed) as asin from nested),
priced as (
  select listed.product, avg(nested.price) as mean_price, count(listed.asin) as n
  from listed left join nested on listed.asin = nested.asin group by listed.product),
viewed as (
  select nested.asin,
    case when len(also_viewed) > 0 then priced.mean_price end as "meanPriceAlsoViewed",
    case when len(also_viewed) > 0 then priced.n end as "countAlsoViewed"
  from nested left join priced on nested.asin = priced.product)"""

RANKED = f"""{NESTED},
ranked as (
  select asin, nullif(top, '') as category,
    case when salesrank <> '{{}}' then p_type end as "bestSalesCategory",
    case when salesrank <> '{{}}' then p_size end as "bestSalesRank"
  from nested)"""

IMPUTED = f"""{P},
single as (select asin, title, cast(price as float) as price from products),
centre as (
  select avg(cast(price as double)) as mean_price, quantile_cont(cast(price as double), 0.5) as median_price
  from single),
imputed as (
  select asin,
    coalesce(cast(price as double), mean_price) as "meanImputedPrice",
    coalesce(cast(price as double), median_price) as "medianImputedPrice",
    case when title is null or title = '' then 'unknown' else title end as "unknownImputedTitle"
  from single, centre)"""

DESCRIBE = """
select count({v}) as count, round(avg({v}), 6) as mean, round(stddev_samp({v}), 6) as std, min({v}) as min,
  round(quantile_cont({v}, 0.25), 6) as q25, round(quantile_cont({v}, 0.5), 6) as q50,
  round(quantile_cont({v}, 0.75), 6) as q75, max({v}) as max
from {table}"""

NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _null_percent(name: str, source: str) -> str:
    return f"select '{name}' as \"column\", round(avg(case when {name} is null then 100.0e0 else 0.0e0 end), 6) as null_percent from {source}"


def _null_percents(names: tuple[str, ...]) -> str:
    return ", ".join(f"round(avg(case when {n} is null then 100.0e0 else 0.0e0 end), 6) as {n}" for n in names)


def _spread(column: str) -> str:
    return (
        f'round(avg("{column}"), 6) as "mean_{column}", round(var_samp("{column}"), 6) as "variance_{column}", '
        f'count(*) - count("{column}") as "numNulls_{column}"'
    )


def _secular(source: str, column: str) -> str:
    """Relations ``levels`` (count c, m categories with it, in falling order j), and ``roots`` with the number of their component.

    Between two neighbouring counts the secular equation has one root, found by halving; it lies ``below`` under the count.  The
    last root is zero.  ``ties`` says how many contrasts a shared count adds.
    """
    return f"""counted as (select {column} as category, count(*) as c from {source} group by {column}),
levels as (select c, count(*) as m, row_number() over (order by c desc) as j, lead(c) over (order by c desc) as next_c from counted group by c),
lists as (select list(cast(c as double) order by j) as cs, list(cast(m as double) order by j) as ms, cast(sum(c * m) as double) as total from levels),
halved as (
  with recursive steps as (
    select 0 as step, j, cast(c as double) as c, 0.0e0 as low, cast(c - next_c as double) as high from levels where next_c is not null
    union all
    select step + 1, j, c,
      case when g > 1 then (low + high) / 2 else low end as low, case when g > 1 then high else (low + high) / 2 end as high
    from (
      select steps.*, list_sum(list_transform(range(1, len(cs) + 1), lambda i: ms[i] * cs[i] * cs[i] / (total * ((cs[i] - c) + (low + high) / 2)))) as g
      from steps, lists where step < 100))
  select j, (low + high) / 2 as below from steps where step = 100),
roots as (
  select levels.j, levels.c, levels.m, coalesce(halved.below, cast(levels.c as double)) as below, total,
    sqrt(list_sum(list_transform(range(1, len(cs) + 1), lambda i: ms[i] * pow(cs[i] / ((cs[i] - levels.c) + coalesce(halved.below, cast(levels.c as double))), 2)))) as norm,
    cast(sum(levels.m) over (order by levels.j) as bigint) - 1 as component
  from levels left join halved on levels.j = halved.j, lists)"""


# Mean of each component: the inverse norm at a root, zero for contrasts.
PCA_MEANS = """component_means as (
  select component, 1 / norm as mean from roots
  union all select component - i, 0.0e0 from (select component, unnest(range(1, m)) as i from roots))"""


def _tree_level(level: int, source: str) -> str:
    """The best cut of every node of a level from the binned lines ``source`` (node, y, three bins)."""
    return f"""facts{level} as (
  select node, feature, bin, count(*) as n, sum(y) as s from (
    select node, y, unnest([0, 1, 2]) as feature, unnest([b0, b1, b2]) as bin from {source}) group by all),
sides{level} as (
  select node, feature, bin, sum(n) over w as ln, sum(s) over w as ls, sum(n) over v as tn, sum(s) over v as ts from facts{level}
  window w as (partition by node, feature order by bin), v as (partition by node, feature)),
best{level} as (
  select *, ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn as gain from sides{level} where tn > ln
  qualify row_number() over (partition by node order by gain desc, feature, bin) = 1)"""


TREE = f"""lines as (
  select l_orderkey % 4 = 3 as held_out, l_quantity, l_discount, l_tax, cast(l_extendedprice as double) as price from lineitem),
cuts as (
  select """ + ", ".join(
    f"list_distinct(quantile_disc({x}, [{', '.join(f'{k / 32}' for k in range(1, 32))}])) as c{i}" for i, x in enumerate(("l_quantity", "l_discount", "l_tax"))
) + """, avg(price) as centre from lines where not held_out),
binned as (
  select held_out, price, price - centre as y, centre, 1 as node, """ + ", ".join(
    f"len(list_filter(c{i}, lambda c: c < {x})) as b{i}" for i, x in enumerate(("l_quantity", "l_discount", "l_tax"))
) + f""" from lines, cuts),
train as (select * from binned where not held_out),
{_tree_level(0, 'train')},
train1 as (
  select t.y, 2 + cast(case feature when 0 then b0 when 1 then b1 else b2 end > bin as int) as node, b0, b1, b2 from train t, best0),
{_tree_level(1, 'train1')}"""

TITLE_PAIRS = r"""titles as (
  select list_filter(regexp_split_to_array(lower(case when p_partkey % 11 = 0 then null when p_partkey % 13 = 0 then '' else p_name end),
    '[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'), lambda word: word <> '') as w from part),
forward as (
  select a, b, count(*) as n from (
    select w[i] as a, w[i + d] as b from (select w, d, unnest(range(1, len(w) - d + 1)) as i from titles, (values (1), (2), (3)) t(d) where len(w) > d))
  group by all),
pairs as (select a, b, cast(sum(n) as bigint) as n from (select a, b, n from forward union all select b, a, n from forward) group by all having sum(n) >= 2),
sums as (select a, sum(n) as n from pairs group by a),
informed as (
  select p.a, p.b, p.n, ln(p.n / cast(x.n as double) * ((select cast(sum(n) as double) from sums) / y.n)) as information
  from pairs p join sums x on p.a = x.a join sums y on p.b = y.a)"""


ORACLE: dict[str, str] = {
    "approximate_quantile_ranks": "select unnest([0.1e0, 0.25e0, 0.5e0, 0.75e0, 0.9e0]) as probability, count(l_extendedprice) as n, true as within from lineitem",
    "merged_sketch_ranks": "select l_returnflag, count(l_extendedprice) as n, true as within from lineitem group by l_returnflag",
    "brand_pca_mean": f"with {_secular('part', 'p_brand')}, {PCA_MEANS} "
    "select cast(component as int) as component, round(mean, 6) as mean from component_means where component < 15",
    "category_means_task": f"""with {P}, sold as (select category from products where category <> ''),
{_secular('sold', 'category')}, {PCA_MEANS}
select 'PCA' as vector, cast(component as int) as place, round(mean, 6) as mean from component_means where component < 3
union all
select 'OneHot', cast(row_number() over (order by c desc, category) - 1 as int), round(c / total, 6) from counted, lists""",
    "type_pca_loadings": f"""with kinds as (select p_type || ' ' || p_size as kind from part), {_secular('kinds', 'kind')},
spaces as (
  select 'root' as space, c, below, norm, 1 as dims, component, total from roots where component < 5
  union all
  select 'tie', c, 0.0e0, 1.0e0, least(m - 1, 5 - (component - (m - 1))), component - (m - 1), total from roots where m > 1 and component - (m - 1) < 5),
placed as (select category, c, row_number() over (partition by c order by category) - 1 as place from counted),
squares as (
  select category as kind, round((s.c - s.below) / (total - 1), 9) as eigenvalue,
    case when space = 'root' then pow(p.c / ((p.c - s.c) + s.below) / norm, 2)
      when p.c = s.c then coalesce(list_sum(list_transform(range(1, cast(dims as bigint) + 1), lambda t: case when place < t then 1 / (t * (t + 1.0e0)) when place = t then t / (t + 1.0e0) else 0 end)), 0)
      else 0 end as square
  from placed p, spaces s)
select kind, round(eigenvalue, 6) as eigenvalue, round(square, 6) as square from (
  select kind, eigenvalue, sum(square) as square from squares group by all) where square > 0.0000005""",
    "level_tree_rmse": f"""with {TREE},
tested as (
  select b.price, b.centre, b.centre + case when s.left0 then r.ls / r.ln else (r.ts - r.ls) / (r.tn - r.ln) end as p1,
    b.centre + case when k.node is null then case when s.left0 then r.ls / r.ln else (r.ts - r.ls) / (r.tn - r.ln) end
      when case k.feature when 0 then b.b0 when 1 then b.b1 else b.b2 end <= k.bin then k.ls / k.ln else (k.ts - k.ls) / (k.tn - k.ln) end as p2
  from binned b, best0 r, lateral (select case r.feature when 0 then b.b0 when 1 then b.b1 else b.b2 end <= r.bin as left0) s
  left join best1 k on k.node = case when s.left0 then 2 else 3 end
  where b.held_out)
select round(sqrt(avg(pow(price - centre, 2))), 6) as rmse_depth_0, round(sqrt(avg(pow(price - p1, 2))), 6) as rmse_depth_1,
  round(sqrt(avg(pow(price - p2, 2))), 6) as rmse_depth_2 from tested""",
    "level_tree_nodes": f"""with {TREE},
found as (select * from best0 union all select * from best1)
select node, ['l_quantity', 'l_discount', 'l_tax'][feature + 1] as feature,
  round(list_sort(case feature when 0 then c0 when 1 then c1 else c2 end)[bin + 1], 6) as cut, round(centre + ts / tn, 6) as prediction, cast(tn as bigint) as n
from found, cuts""",
    "title_information": f"with {TITLE_PAIRS} select a, b, n, round(information, 6) as information from informed where information > 0",
    "null_pct_reviews": f"with {R} select {_null_percents(('asin', 'overall', 'reviewer'))} from reviews",
    "null_pct_products": f"with {P} "
    + " union all ".join(_null_percent(n, "products") for n in ("asin", "title", "price", "category")),
    "null_pct_doc_labels": "with labelled as (select d.*, l.quality, l.toxic from documents d left join labels l on d.doc_id = l.doc_id) "
    f"select {_null_percents(('doc_id', 'text', 'lang', 'source', 'n_chars', 'quality', 'toxic'))} from labelled",
    "na_tokens": """
with typed as (
  select l_orderkey, l_partkey,
    case when l_orderkey % 23 in (0, 1, 2) then null when l_orderkey % 23 = 3 then ' NA' when l_orderkey % 23 = 4 then 'na'
      else cast(cast(l_quantity as int) as varchar) end as overall
  from lineitem)
select l_orderkey, l_partkey, overall, try_cast(overall as double) as rating from typed""",
    "price_stats": f"""with {P}
select round(avg(price), 6) as mean, round(stddev_samp(price), 6) as std, min(price) as min, max(price) as max,
  round(quantile_cont(price, 0.5), 6) as median
from products""",
    "price_describe": f"with {P} " + DESCRIBE.format(v="price", table="products"),
    "line_price_describe": DESCRIBE.format(v="l_extendedprice", table="lineitem"),
    "order_key_quantiles": """
with moved as (select cast(l_orderkey as bigint) + 1152921504606846976 as k from lineitem),
ranked as (select k, row_number() over (order by k) as i, count(*) over () as n from moved),
middle as (select min(k) as low, max(k) as high from ranked where i in ((n + 1) // 2, n // 2 + 1))
select count(*) as n, """
    + ", ".join(f"quantile_disc(k, {p}) as p{round(p * 100)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9))
    + """, any_value((select cast(cast(low as decimal(38,6)) + cast(high - low as decimal(38,6)) * 0.5 as decimal(38,6))::varchar from middle)) as median from moved""",
    "wide_decimal_quantiles": """
with wide as (
  select cast(case when l_orderkey % 2 = 0 then 1 else -1 end * cast(round(cast(l_extendedprice as decimal(12,2)) * 100) as hugeint)
    * 10000000000000000001 as hugeint) as u from lineitem),
picked as (select count(*) as n, """
    + ", ".join(f"quantile_disc(u, {p}) as p{round(p * 100)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9))
    + """ from wide)
select n, """
    + ", ".join(
        f"case when p{q} < 0 then '-' else '' end || (abs(p{q}) // 10000) || '.' || lpad(cast(abs(p{q}) % 10000 as varchar), 4, '0') as p{q}" for q in (10, 25, 50, 75, 90)
    )
    + " from picked",
    "price_quantile_disc": f"with {P} select count(price) as n, "
    + ", ".join(f"quantile_disc(price, {p}) as p{round(p * 100)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9))
    + " from products",
    "corr_matrix_lineitem": " union all ".join(
        f"select '{x}' as x, '{y}' as y, round(corr({x}, {y}), 6) as corr from lineitem" for x in NUMERIC for y in NUMERIC
    ),
    "event_type_counts": "select event_type, count(*) as n from events where event_type is not null group by event_type",
    "distinct_part_types": "select p_type from part where p_type is not null group by p_type",
    "supercategory_counts": f"with {NESTED} select top as supercat, count(*) as n from nested where top <> '' group by top",
    "profile_report": f"""with {R}, {NESTED},
q12 as (
  select
    (select avg(case when asin is null then 100.0e0 else 0.0e0 end) from reviews) as q1_asin,
    (select avg(case when overall is null then 100.0e0 else 0.0e0 end) from reviews) as q1_overall,
    (select avg(case when reviewer is null then 100.0e0 else 0.0e0 end) from reviews) as q1_reviewer,
    avg(case when asin is null then 100.0e0 else 0.0e0 end) as q2_asin,
    avg(case when price is null then 100.0e0 else 0.0e0 end) as q2_price,
    avg(case when categories is null then 100.0e0 else 0.0e0 end) as q2_categories,
    avg(case when related is null then 100.0e0 else 0.0e0 end) as q2_related,
    (select corr(overall, nested.price) from reviews join nested on reviews.asin = nested.asin
      where overall is not null and nested.price is not null) as q3,
    avg(price) as q4_mean, stddev_samp(price) as q4_std, min(price) as q4_min, max(price) as q4_max,
    quantile_cont(price, 0.5) as q4_median
  from nested)
select 'q1' as question, unnest(['asin', 'overall', 'reviewer']) as name,
  unnest([round_even(q1_asin, 2), round_even(q1_overall, 2), round_even(q1_reviewer, 2)]) as value from q12
union all select 'q2', unnest(['asin', 'price', 'categories', 'related']),
  unnest([round_even(q2_asin, 2), round_even(q2_price, 2), round_even(q2_categories, 2), round_even(q2_related, 2)]) from q12
union all select 'q3', 'corr', round_even(q3, 2) from q12
union all select 'q4', unnest(['mean', 'std', 'min', 'max', 'median']),
  unnest([round_even(q4_mean, 2), round_even(q4_std, 2), round_even(q4_min, 2), round_even(q4_max, 2), round_even(q4_median, 2)]) from q12
union all select 'q5', top, cast(count(*) as double) from nested where top <> '' group by top
union all select 'q6', 'dangling', cast(exists (select 1 from reviews where asin not in (select asin from nested)) as double)
union all select 'q7', 'dangling', cast(exists (select 1 from mentions where asin not in (select asin from nested)) as double)""",
    "profile_report_map": f"""with {R}, {NESTED}
select
  (select round_even(avg(case when overall is null then 100.0e0 else 0.0e0 end), 2) from reviews) as null_overall,
  (select round_even(avg(case when price is null then 100.0e0 else 0.0e0 end), 2) from nested) as null_price,
  (select round_even(corr(overall, nested.price), 2) from reviews join nested on reviews.asin = nested.asin
    where overall is not null and nested.price is not null) as corr,
  (select round_even(quantile_cont(price, 0.5), 2) from nested) as median,
  (select cast(exists (select 1 from reviews where asin not in (select asin from nested)) as bigint)) as dangling,
  (select cast(exists (select 1 from mentions where asin not in (select asin from nested)) as bigint)) as dangling_related,
  top as supercat, count(*) as n
from nested where top <> '' group by top""",
    "development_reviews": f"with {R} select * from reviews where cast('0x' || substr(md5(asin), 1, 8) as bigint) % 100 < 10",
    "inner_join_rated_prices": f"""with {P}, {R}
select reviews.asin, overall, price from reviews join products on reviews.asin = products.asin
where overall is not null and price is not null""",
    "rating_price_corr": f"""with {P}, {R}
select round(corr(overall, price), 6) as corr from reviews join products on reviews.asin = products.asin""",
    "shifted_price_corr": """
select round(corr(l_partkey % 100 + l_quantity % 5, 1.0e7 + (p_partkey % 100) / 100.0e0), 6) as corr
from lineitem join part on l_partkey = p_partkey where p_partkey % 3 = 0""",
    "review_match_flag": f"""with {P}, {R}
select asin, overall, reviewer, asin in (select asin from products) as matched from reviews""",
    "dangling_reviews": f"""with {P}, {R}
select asin, overall, reviewer from reviews where asin not in (select asin from products)""",
    "dangling_review_keys": f"""with {P}, {R}
select asin, count(*) as n from reviews where asin not in (select asin from products) group by asin""",
    "dangling_reviews_flag": f"""with {P}, {R}
select cast(exists (select 1 from reviews where asin not in (select asin from products)) as int) as dangling""",
    "dangling_related": f"""with {NESTED}
select asin, count(*) as n from mentions where asin not in (select asin from nested) group by asin""",
    "dangling_related_flag": f"""with {NESTED}
select cast(exists (select 1 from mentions where asin not in (select asin from nested)) as int) as dangling_related""",
    "unlabelled_documents": """
select doc_id, lang, source, n_chars from documents where doc_id not in (select doc_id from labels)""",
    "key_set_difference": f"with {P}, {R} select asin from products except select asin from reviews",
    "category_lists": f"with {NESTED} select asin, top, sub, false as categories_bad from nested",
    "related_lists": f"""with {NESTED}
select asin, array_to_string(also_viewed, ',') as also_viewed, array_to_string(bought_together, ',') as bought_together,
  coalesce(array_to_string(list_concat(coalesce(also_viewed, []), coalesce(bought_together, [])), ','), '') as all_ids,
  false as related_bad
from nested""",
    "related_mentions": f"with {NESTED} select asin, count(*) as n from mentions where asin is not null group by asin",
    "also_viewed_prices": f"""with {NESTED},
opened as (
  select asin, unnest(case when len(also_viewed) > 0 then also_viewed else [null] end) as also_viewed_asin from nested)
select opened.asin, also_viewed_asin, nested.price from opened left join nested on opened.also_viewed_asin = nested.asin""",
    "rating_per_product": f"""with {RATINGS}
select asin, round("meanRating", 6) as "meanRating", cast("countRating" as double) as "countRating" from rated""",
    "rating_stats": f"with {RATINGS} select count(*) as count_total, {_spread('meanRating')}, {_spread('countRating')} from rated",
    "sales_rank_features": f"""with {RANKED}
select asin, category, "bestSalesCategory", cast("bestSalesRank" as double) as "bestSalesRank" from ranked""",
    "sales_rank_stats": f"""with {RANKED}
select count(*) as count_total, round(avg("bestSalesRank"), 6) as "mean_bestSalesRank",
  round(var_samp("bestSalesRank"), 6) as "variance_bestSalesRank",
  count(*) - count(category) as "numNulls_category", count(distinct category) as "countDistinct_category",
  count(*) - count("bestSalesCategory") as "numNulls_bestSalesCategory",
  count(distinct "bestSalesCategory") as "countDistinct_bestSalesCategory"
from ranked""",
    "also_viewed_features": f"""with {VIEWED}
select asin, round("meanPriceAlsoViewed", 6) as "meanPriceAlsoViewed",
  cast("countAlsoViewed" as double) as "countAlsoViewed" from viewed""",
    "also_viewed_stats": f"""with {VIEWED}
select count(*) as count_total, {_spread('meanPriceAlsoViewed')}, {_spread('countAlsoViewed')} from viewed""",
    "imputed_prices": f"""with {IMPUTED}
select asin, round("meanImputedPrice", 6) as "meanImputedPrice", round("medianImputedPrice", 6) as "medianImputedPrice",
  "unknownImputedTitle" from imputed""",
    "imputed_stats": f"""with {IMPUTED}
select count(*) as count_total, {_spread('meanImputedPrice')}, {_spread('medianImputedPrice')},
  count(*) filter (where "unknownImputedTitle" = 'unknown') as "numUnknowns_unknownImputedTitle" from imputed""",
    "title_tokens": f"""with {P},
split as (select asin, list_filter(regexp_split_to_array(lower(coalesce(title, '')), '\\s+'), lambda w: w <> '') as words
  from products)
select asin, cast(len(words) as int) as n_tokens, array_to_string(words, '|') as tokens from split""",
    "document_token_counts": f"""with {WORDS}
select doc_id, cast(len(words) as int) as n_tokens, cast(length(array_to_string(words, '')) as int) as n_token_chars
from words""",
    "document_vocabulary": f"""with {WORDS}
select word, count(*) as n from (select unnest(words) as word from words) group by word having count(*) >= 100""",
    "cosine_top_k": """
with scored as (
  select cast(q.vec_id as varchar) as query, e.vec_id,
    list_cosine_similarity(cast(e.embedding as double[]), cast(q.embedding as double[])) as similarity
  from embeddings e, embeddings q where q.vec_id in (0, 1, 2)),
ranked as (
  select *, row_number() over (partition by query order by similarity desc, vec_id) as place from scored)
select query, cast(place as int) as "rank", vec_id, round(similarity, 6) as similarity from ranked where place <= 10""",
    "brand_index": """
with levels as (
  select p_brand, cast(row_number() over (order by count(*) desc, p_brand) - 1 as double) as brand_index
  from part group by p_brand)
select p_partkey, part.p_brand, brand_index from part join levels on part.p_brand = levels.p_brand""",
    "brand_one_hot_mean": """
select cast(row_number() over (order by count(*) desc, p_brand) - 1 as int) as brand_index,
  round(count(*) / (select count(*) from part), 6) as mean
from part group by p_brand""",
    "rmse_group_mean": """
with scored as (
  select l_extendedprice as y, avg(l_extendedprice) over (partition by l_returnflag) as p from lineitem)
select round(sqrt(avg((y - p) * (y - p))), 6) as rmse from scored""",
    "rmse_group_variance": """
with scored as (
  select l_extendedprice as y, avg(l_extendedprice) over (partition by l_returnflag) as p from lineitem)
select round(sqrt(avg((y - p) * (y - p))), 6) as rmse from scored""",
    "lowest_rmse_candidate": "with errors as ("
    + " union all ".join(
        f"select '{c}' as candidate, sqrt(avg((y - p) * (y - p))) as rmse from "
        f"(select l_extendedprice as y, avg(l_extendedprice) over (partition by {c}) as p from lineitem)"
        for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    )
    + ") select candidate, round(rmse, 6) as rmse from errors order by rmse, candidate limit 1",
}
