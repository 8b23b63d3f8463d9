"""The same questions in DuckDB SQL over the driver's tables.

Every check is one statement; the views below are put in front of it when it names them. They are
written from the rules in FIXTURES.md and share nothing with the Spark code.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "movie": """
        SELECT o_orderkey AS id, 'Order ' || o_orderkey AS title, year(o_orderdate) AS year, o_custkey AS did,
               'Person ' || o_custkey AS dname, o_orderpriority AS genre, c_mktsegment AS studio, n_name AS country
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "ranked": """
        SELECT l_orderkey AS mid, l_suppkey AS aid, l_partkey AS pid,
               row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS bo
        FROM lineitem""",
    "role": """
        SELECT mid, aid, pid, bo, CASE WHEN p_size % 10 = 0 THEN '' ELSE p_name END AS ch,
               bo = min(bo) OVER (PARTITION BY mid, aid) AS first_time
        FROM (SELECT * FROM ranked WHERE bo <= 3) JOIN part ON p_partkey = pid""",
    "roled": """
        SELECT *, 'http://kg.example/resource/role/' || mid || '-' || aid
                  || CASE WHEN first_time THEN '' ELSE '-' || bo END AS role
        FROM role""",
    "known": """
        SELECT c_custkey AS k, c_nationkey AS nk FROM customer
        UNION ALL SELECT s_suppkey, NULL FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer)""",
    "people": "SELECT o_custkey AS k FROM orders UNION SELECT aid FROM role",
    "pitem": """
        SELECT k, 'http://www.wikidata.org/entity/Q' || k || suffix AS item,
               CASE WHEN k % 11 <> 0 THEN 'Person_' || k END AS article
        FROM known, (VALUES (''), ('b')) x(suffix)
        WHERE k % 37 <> 0 AND (suffix = '' OR k % 50 = 1)""",
    "plinked": """
        SELECT k, min(item) AS item, min(article) AS article FROM pitem JOIN people USING (k)
        GROUP BY k HAVING count(DISTINCT (item, article)) = 1""",
    "psame": """
        SELECT * FROM (
          SELECT k, 'http://dbpedia.org/resource/' || CASE WHEN k % 3 = 0 THEN 'Person%5F' ELSE 'Person_' END || k AS res,
                 'Person' AS class, NULL AS target FROM known WHERE k % 5 <> 0
          UNION ALL SELECT k, 'http://dbpedia.org/resource/Person_' || k || '_(old)', 'Person', NULL FROM known WHERE k % 5 = 0
          UNION ALL SELECT k, 'http://dbpedia.org/resource/Other_' || k, 'Person', NULL FROM known WHERE k % 10 = 0
          UNION ALL SELECT k, 'http://dbpedia.org/resource/Soundtrack_' || k, 'Work', NULL FROM known WHERE k % 4 = 0
          UNION ALL SELECT k, 'http://fr.dbpedia.org/resource/Person_' || k, 'Person', NULL FROM known WHERE k % 6 = 0
          UNION ALL SELECT k, 'http://dbpedia.org/resource/Redir_' || k, 'Person',
                           'http://dbpedia.org/resource/Person_' || k FROM known WHERE k % 7 = 0
          UNION ALL SELECT k, 'http://dbpedia.org/resource/Merged_' || k, 'Person',
                           'http://dbpedia.org/resource/Someone_else' FROM known WHERE k % 13 = 0)""",
    "pcand": """
        SELECT DISTINCT l.k, l.item, coalesce(s.target, s.res) AS cand,
               'http://dbpedia.org/resource/' || l.article AS expected,
               replace(coalesce(s.target, s.res), '%5F', '_') AS decoded
        FROM plinked l JOIN psame s ON l.item = 'http://www.wikidata.org/entity/Q' || s.k
        WHERE s.class = 'Person' AND s.res LIKE 'http://dbpedia.org/resource/%'
          AND (s.target IS NULL OR replace(s.target, '%5F', '_') = 'http://dbpedia.org/resource/' || l.article)""",
    "pchoice": """
        SELECT k, item, res FROM (
          SELECT k, item, coalesce(min(cand) FILTER (WHERE decoded = expected),
                                   CASE WHEN count(*) = 1 THEN min(cand) END) AS res
          FROM pcand GROUP BY k, item) WHERE res IS NOT NULL""",
    "report": """
        SELECT 'movie' AS kind, 'http://kg.example/resource/movie/' || o_orderkey AS uri,
               'Order ' || o_orderkey AS label,
               CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE 'http://www.wikidata.org/entity/F' || o_orderkey END AS wikidata,
               CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE 'http://dbpedia.org/resource/Order_' || o_orderkey END AS dbpedia
        FROM orders
        UNION ALL
        SELECT 'person', 'http://kg.example/resource/person/' || p.k, 'Person ' || p.k,
               coalesce(l.item, ''), coalesce(c.res, '')
        FROM people p LEFT JOIN plinked l ON p.k = l.k LEFT JOIN pchoice c ON p.k = c.k""",
    "sameas": """
        SELECT uri AS s, wikidata AS o FROM report WHERE wikidata <> ''
        UNION SELECT uri, dbpedia FROM report WHERE dbpedia <> ''""",
    "holders": "SELECT k, item FROM plinked JOIN customer ON k = c_custkey WHERE c_acctbal > 9000",
    "mlink": """
        SELECT o_orderkey AS id, 'http://dbpedia.org/resource/Order_' || o_orderkey AS dbp
        FROM orders WHERE o_orderkey % 37 <> 0""",
    "birth": """
        SELECT 'http://www.wikidata.org/entity/Q' || k AS item,
               strftime(DATE '1940-01-01' + CAST(k * 37 % 20000 AS INTEGER), '%Y-%m-%d') || 'T00:00:00Z' AS born
        FROM known WHERE k % 23 <> 0
        UNION ALL
        SELECT 'http://www.wikidata.org/entity/Q' || k,
               strftime(DATE '1940-01-01' + CAST(k * 37 % 20000 + 400 AS INTEGER), '%Y-%m-%d') || 'T00:00:00Z'
        FROM known WHERE k % 9 = 0
        UNION ALL
        SELECT 'http://www.wikidata.org/entity/Q' || k, 'http://www.wikidata.org/.well-known/genid/' || k
        FROM known WHERE k % 23 = 0""",
    "dbname": """
        SELECT k, nk, 'http://dbpedia.org/resource/Person_' || k AS res FROM known
        UNION ALL SELECT k, nk, 'http://dbpedia.org/resource/Person%5F' || k FROM known WHERE k % 3 = 0
        UNION ALL SELECT k, nk, 'http://dbpedia.org/resource/Person_' || k || '_(old)' FROM known WHERE k % 5 = 0""",
    # the graph: (s, p, o, kind, lang) with short predicate names
    "dimension": """
        SELECT DISTINCT 'Genre' AS class, 'http://kg.example/ontology/genre_'
                 || trim(regexp_replace(lower(genre), '[^a-z0-9]+', '_', 'g'), '_') AS node, genre AS label FROM movie
        UNION SELECT DISTINCT 'Studio', 'http://kg.example/ontology/studio/'
                 || trim(regexp_replace(lower(studio), '[^a-z0-9]+', '-', 'g'), '-'), studio FROM movie
        UNION SELECT DISTINCT 'Country', 'http://kg.example/ontology/country/'
                 || trim(regexp_replace(lower(country), '[^a-z0-9]+', '-', 'g'), '-'), country FROM movie""",
    "node": """
        SELECT m.*, 'http://kg.example/resource/movie/' || id AS s, 'http://kg.example/resource/person/' || did AS d,
               'http://kg.example/ontology/genre_' || trim(regexp_replace(lower(genre), '[^a-z0-9]+', '_', 'g'), '_') AS g,
               'http://kg.example/ontology/studio/' || trim(regexp_replace(lower(studio), '[^a-z0-9]+', '-', 'g'), '-') AS st,
               'http://kg.example/ontology/country/' || trim(regexp_replace(lower(country), '[^a-z0-9]+', '-', 'g'), '-') AS co
        FROM movie m""",
    "rolenode": """
        SELECT *, 'http://kg.example/resource/movie/' || mid AS m, 'http://kg.example/resource/person/' || aid AS a FROM roled""",
    "tri": """
        SELECT DISTINCT s, p, o, kind, lang FROM (
          SELECT s, 'rdf:type' AS p, 'http://schema.org/Movie' AS o, 'iri' AS kind, '' AS lang FROM node
          UNION ALL SELECT s, 'dc:title', title, 'lit', '' FROM node
          UNION ALL SELECT s, 'ont:releaseYear', CAST(year AS VARCHAR), 'lit', '' FROM node
          UNION ALL SELECT s, 'dbo:director', d, 'iri', '' FROM node
          UNION ALL SELECT s, 'ont:hasGenre', g, 'iri', '' FROM node
          UNION ALL SELECT s, 'ont:producedBy', st, 'iri', '' FROM node
          UNION ALL SELECT s, 'ont:producedIn', co, 'iri', '' FROM node
          UNION ALL SELECT d, 'rdf:type', 'http://xmlns.com/foaf/0.1/Person', 'iri', '' FROM node
          UNION ALL SELECT d, 'rdf:type', 'http://kg.example/ontology/Director', 'iri', '' FROM node
          UNION ALL SELECT d, 'foaf:name', dname, 'lit', '' FROM node
          UNION ALL SELECT a, 'rdf:type', 'http://xmlns.com/foaf/0.1/Person', 'iri', '' FROM rolenode
          UNION ALL SELECT a, 'rdf:type', 'http://kg.example/ontology/Actor', 'iri', '' FROM rolenode
          UNION ALL SELECT a, 'foaf:name', 'Person ' || aid, 'lit', '' FROM rolenode
          UNION ALL SELECT m, 'dbo:starring', a, 'iri', '' FROM rolenode
          UNION ALL SELECT role, 'rdf:type', 'http://kg.example/ontology/CastRole', 'iri', '' FROM rolenode
          UNION ALL SELECT m, 'ont:hasCastRole', role, 'iri', '' FROM rolenode
          UNION ALL SELECT role, 'ont:roleInMovie', m, 'iri', '' FROM rolenode
          UNION ALL SELECT role, 'ont:playedBy', a, 'iri', '' FROM rolenode
          UNION ALL SELECT role, 'ont:billingOrder', CAST(bo AS VARCHAR), 'lit', '' FROM rolenode
          UNION ALL SELECT role, 'ont:characterName', ch, 'lit', '' FROM rolenode WHERE ch <> ''
          UNION ALL SELECT role, 'rdfs:label', 'Person ' || aid || CASE WHEN ch = '' THEN '' ELSE ' as ' || ch END
                           || ' in Order ' || mid, 'lit', 'en' FROM rolenode
          UNION ALL SELECT node, 'rdf:type', 'http://kg.example/ontology/' || class, 'iri', '' FROM dimension
          UNION ALL SELECT node, 'rdfs:label', label, 'lit', 'en' FROM dimension)""",
    "awardtri": """
        SELECT 'http://kg.example/resource/person/' || k AS s, 'ont:hasAward' AS p,
               'http://kg.example/ontology/award_best_director' AS o FROM holders
        UNION ALL SELECT 'http://kg.example/ontology/award_best_director', 'rdf:type', 'http://kg.example/ontology/Award'
        UNION ALL SELECT 'http://kg.example/ontology/award_best_director', 'rdfs:label', 'Academy Award for Best Director'""",
    "pub": """
        SELECT 'movies_linked' AS g, s, p, o FROM tri
        UNION ALL SELECT 'movies_linked', s, 'owl:sameAs', o FROM sameas
        UNION ALL SELECT 'awards', s, p, o FROM awardtri""",
    "prefix": """
        SELECT * FROM (VALUES
          ('rdf', 'http://www.w3.org/1999/02/22-rdf-syntax-ns#'), ('rdfs', 'http://www.w3.org/2000/01/rdf-schema#'),
          ('owl', 'http://www.w3.org/2002/07/owl#'), ('dc', 'http://purl.org/dc/elements/1.1/'),
          ('dbo', 'http://dbpedia.org/ontology/'), ('foaf', 'http://xmlns.com/foaf/0.1/'),
          ('ont', 'http://kg.example/ontology/')) x(short, iri)""",
    # bytes of a published triple as a line of N-Triples
    "publine": """
        SELECT g, p, strlen(s) + strlen(iri) + strlen(p) - strlen(short) - 1 + strlen(o) + 11
                  + CASE WHEN p IN ('ont:releaseYear', 'ont:billingOrder') THEN 4 + strlen('http://www.w3.org/2001/XMLSchema#integer')
                         WHEN p = 'rdfs:label' THEN strlen('@en') ELSE 0 END AS bytes
        FROM pub JOIN prefix ON split_part(p, ':', 1) = short""",
    "pubfile": "SELECT g, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM publine GROUP BY g",
    # memberships before and after the closure
    "asserted": "SELECT s, o AS class FROM tri WHERE p = 'rdf:type' UNION SELECT s, o FROM awardtri WHERE p = 'rdf:type'",
    "super": """
        SELECT * FROM (VALUES ('Director', 'Person'), ('Actor', 'Person'), ('ActorDirector', 'Person'),
          ('AwardWinningDirector', 'Director'), ('AwardWinningDirector', 'Person')) x(sub, sup)""",
    "closed": """
        SELECT DISTINCT s, class FROM (
          SELECT s, class FROM asserted
          UNION ALL SELECT s, 'http://kg.example/ontology/' || sup FROM asserted JOIN super
                    ON class = 'http://kg.example/ontology/' || sub
          UNION ALL SELECT s, 'http://xmlns.com/foaf/0.1/Person' FROM asserted JOIN super
                    ON class = 'http://kg.example/ontology/' || sub AND sup = 'Person'
          UNION ALL SELECT s, 'http://kg.example/ontology/Movie' FROM asserted WHERE class = 'http://schema.org/Movie'
          UNION ALL SELECT s, 'http://kg.example/ontology/Person' FROM asserted
                    WHERE class = 'http://xmlns.com/foaf/0.1/Person')""",
    "acting": "SELECT DISTINCT d FROM node JOIN rolenode ON s = m AND d = a",
    "reported": """
        SELECT s, 'http://kg.example/ontology/' || CASE genre WHEN '1-URGENT' THEN 'ActionMovie' ELSE 'ComedyMovie' END AS class
        FROM node WHERE genre IN ('1-URGENT', '5-LOW')
        UNION SELECT d, 'http://kg.example/ontology/ActorDirector' FROM acting
        UNION SELECT role, 'http://kg.example/ontology/CastRole' FROM roled
        UNION SELECT 'http://kg.example/resource/person/' || k, 'http://kg.example/ontology/AwardWinningDirector'
              FROM holders WHERE k IN (SELECT did FROM movie)""",
    "sampled": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY md5('42' || uri), uri) AS rn
                       FROM report WHERE wikidata <> '' OR dbpedia <> '') WHERE rn <= 15""",
    "clusters": """
        SELECT uri, 1 + count(DISTINCT o) AS size FROM report JOIN sameas ON s = uri GROUP BY uri""",
}

# Triples of the ontology, and how many of them the movie data states as well.
ONTOLOGY_TRIPLES, SHARED = 115, 4
XS = "http://www.w3.org/2001/XMLSchema#"

O = "http://kg.example/ontology/"  # noqa: E741

# people who play one line of every 499th movie, and the smallest name that can be reached from each
NAMES = """
    lines AS (
      SELECT DISTINCT 'http://kg.example/resource/line/' || l_orderkey || '-' || l_linenumber AS line,
        'http://kg.example/resource/movie/' || l_orderkey AS m, 'http://kg.example/resource/person/' || l_suppkey AS a
      FROM lineitem WHERE l_orderkey % 499 = 0),
    linked AS (SELECT DISTINCT x.a AS a, y.a AS b FROM lines x JOIN lines y ON x.line = y.line AND x.a <> y.a),
    reached(a, b) AS (SELECT a, b FROM linked UNION SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a),
    named AS (SELECT a AS name, min(least(a, b)) AS cluster FROM reached GROUP BY a)"""

CHECKS: dict[str, str] = {
    "q01_movies_by_director": "SELECT title FROM movie WHERE dname = 'Person 9'",
    "q02_movies_after_year": "SELECT title, year FROM movie WHERE year > 1999",
    "q03_top_directors": """SELECT dname AS "directorName", count(*) AS "movieCount" FROM movie
        GROUP BY dname ORDER BY 2 DESC, 1 LIMIT 5""",
    "q04_movies_linked": """SELECT 'Order ' || id AS title, dbp AS "dbpediaResource" FROM mlink""",
    "q05_movies_with_actor": "SELECT DISTINCT title FROM movie JOIN role ON id = mid WHERE aid = 5",
    "q06_director_birth": """
        SELECT dname AS name, string_agg(DISTINCT substr(born, 1, 10), ', ' ORDER BY substr(born, 1, 10)) AS "birthDates",
               string_agg(DISTINCT coalesce(n_name, '(unknown)'), ', ' ORDER BY coalesce(n_name, '(unknown)')) AS "birthPlaces",
               title, year
        FROM movie JOIN plinked l ON did = l.k JOIN birth b ON b.item = l.item JOIN known n ON n.k = did
             LEFT JOIN nation ON n.nk = n_nationkey AND did % 7 <> 0
        WHERE dname IN ('Person 9', 'Person 7') GROUP BY dname, title, year""",
    "q07_director_age": """
        SELECT name, movies, "firstYear", born AS "birthDate",
               "firstYear" - year(try_cast(substr(born, 1, 10) AS DATE)) AS "ageAtFirstMovie"
        FROM (SELECT did, dname AS name, count(*) AS movies, min(year) AS "firstYear" FROM movie
              GROUP BY did, dname HAVING count(*) >= 6) m
             JOIN plinked l ON m.did = l.k JOIN birth b ON b.item = l.item""",
    "q08_cast_age": """
        SELECT title, 'Person ' || aid AS actor, born AS "birthDate",
               year - year(try_cast(substr(born, 1, 10) AS DATE)) AS "ageAtRelease"
        FROM (SELECT DISTINCT mid, aid FROM role) JOIN movie ON mid = id JOIN plinked l ON l.k = aid
             JOIN birth b ON b.item = l.item WHERE title = 'Order 42'""",
    "q09_budget_gross": """
        SELECT title, year, title AS label, CASE WHEN m.id % 3 <> 0 THEN o_totalprice END AS "maxBudget",
               CASE WHEN m.id % 4 <> 0 THEN 2 * o_totalprice END AS "maxGross"
        FROM movie m JOIN mlink USING (id) JOIN orders ON m.id = o_orderkey WHERE dname = 'Person 9'""",
    "q10_year_check": """
        SELECT title, year, min(year(l_shipdate)) AS "wikidataYear"
        FROM movie JOIN lineitem ON id = l_orderkey WHERE year = 1999 AND id % 37 <> 0 GROUP BY id, title, year""",
    "q11_probe": """SELECT 'Order 42' AS label, CAST(NULL AS DOUBLE) AS budget, 2 * o_totalprice AS gross
        FROM orders WHERE o_orderkey = 42""",
    "q12_links_exist": """
        SELECT title, year, title AS label, NULL AS "redirectsTo" FROM movie JOIN mlink USING (id) WHERE dname = 'Person 9'
        UNION ALL SELECT title, year, NULL, dbp || '_(film)' FROM movie JOIN mlink USING (id)
        WHERE dname = 'Person 9' AND id % 20 = 0""",
    "q13_abstracts": """
        SELECT title, year, substr(text, 1, 150) AS start FROM movie JOIN mlink USING (id)
        JOIN documents ON doc_id = id // 15 WHERE dname = 'Person 9' AND lang = 'en'""",
    "q14_cast_birth_year": """
        SELECT title, 'Person ' || aid AS actor,
               year(DATE '1940-01-01' + CAST(aid * 37 % 20000 AS INTEGER)) AS "birthYear",
               year - year(DATE '1940-01-01' + CAST(aid * 37 % 20000 AS INTEGER)) AS "ageAtRelease"
        FROM (SELECT DISTINCT mid, aid FROM role) JOIN movie ON mid = id JOIN pchoice c ON c.k = aid
             JOIN dbname d ON d.res = c.res
        WHERE title = 'Order 42' AND d.k % 8 <> 0""",
    "q15_birthplaces": """
        SELECT 'Person ' || c.k AS name, string_agg(DISTINCT place, ', ' ORDER BY place) AS "birthPlaces"
        FROM pchoice c JOIN dbname d ON d.res = c.res JOIN nation ON d.nk = n_nationkey,
             unnest([replace(n_name, '_', ' '), n_name]) x(place)
        WHERE c.k = 9 AND d.k % 7 <> 0 GROUP BY c.k""",
    "q16_cast_of_movie": """SELECT bo AS "order", 'Person ' || aid AS actor, nullif(ch, '') AS character
        FROM role WHERE mid = 42""",
    "q17_roles_of_actor": """SELECT year, title, nullif(ch, '') AS character, bo AS "order"
        FROM role JOIN movie ON mid = id WHERE aid = 5""",
    "q18_shared_characters": """
        SELECT ch AS character, count(*) AS movies, count(DISTINCT aid) AS actors,
               string_agg(DISTINCT 'Person ' || aid, ', ' ORDER BY 'Person ' || aid) AS "playedBy"
        FROM role WHERE ch <> '' GROUP BY ch HAVING count(*) > 1""",
    "q19_top_billed": """SELECT 'Person ' || aid AS actor, count(*) AS "timesTopBilled" FROM role WHERE bo = 1
        GROUP BY aid ORDER BY 2 DESC, 1 LIMIT 10""",
    "q20_directors_acting": """SELECT dname AS name, title, year, nullif(ch, '') AS character, bo AS "order"
        FROM role JOIN movie ON mid = id AND aid = did""",
    "q21_role_consistency": """
        WITH starring AS (SELECT DISTINCT m AS s, a AS o FROM rolenode)
        SELECT (SELECT count(*) FROM starring x WHERE NOT EXISTS (SELECT 1 FROM rolenode y WHERE y.m = x.s AND y.a = x.o))
                 AS "starringWithoutRole",
               (SELECT count(*) FROM rolenode y WHERE NOT EXISTS (SELECT 1 FROM starring x WHERE y.m = x.s AND y.a = x.o))
                 AS "roleWithoutStarring" """,
    "stats_triples": f"""SELECT count(*) + {ONTOLOGY_TRIPLES} AS per_file_sum,
        count(*) + {ONTOLOGY_TRIPLES} - {SHARED} AS merged FROM pub""",
    "stats_classes": """
        SELECT name, count(DISTINCT s) AS individuals
        FROM (VALUES ('Movie', 'http://schema.org/Movie'), ('Person', 'http://xmlns.com/foaf/0.1/Person'),
              ('Director', 'http://kg.example/ontology/Director'), ('Actor', 'http://kg.example/ontology/Actor'),
              ('Genre', 'http://kg.example/ontology/Genre'), ('Studio', 'http://kg.example/ontology/Studio'),
              ('Country', 'http://kg.example/ontology/Country'), ('CastRole', 'http://kg.example/ontology/CastRole'))
             c(name, class) LEFT JOIN tri ON p = 'rdf:type' AND o = class GROUP BY name""",
    "stats_links": """
        SELECT target, count(*) FILTER (WHERE kind = 'movie') AS movies, count(*) FILTER (WHERE kind = 'person') AS people,
               count(*) AS total
        FROM (SELECT kind, unnest(['wikidata.org', 'dbpedia.org']) AS target, unnest([wikidata, dbpedia]) AS iri FROM report)
        WHERE iri <> '' GROUP BY target""",
    "stats_genres": "SELECT genre, count(*) AS movies FROM movie GROUP BY genre",
    "stats_top_directors": """SELECT dname AS name, count(*) AS movies FROM movie GROUP BY did, dname
        ORDER BY 2 DESC, 1 LIMIT 5""",
    "clean_top_rated": """
        WITH votes AS (SELECT l_orderkey, count(*) AS v FROM lineitem GROUP BY 1),
        best AS (SELECT m.*, o_totalprice, o_orderdate FROM movie m JOIN orders ON id = o_orderkey
                 JOIN votes ON id = l_orderkey WHERE v >= 4 AND id % 97 <> 0
                 ORDER BY floor(o_totalprice / 50000) DESC, v DESC, id LIMIT 250)
        SELECT CAST(id AS VARCHAR) AS id, title, CAST(year AS VARCHAR) AS year,
               strftime(o_orderdate, '%Y-%m-%d') AS release_date, CAST(id % 180 AS VARCHAR) AS runtime,
               CAST(did AS VARCHAR) AS director_id, dname AS director_name, genre, genre AS genres,
               coalesce(ids, '') AS cast_ids, coalesce(names, '') AS cast_names, coalesce(chs, '') AS cast_characters,
               studio, country
        FROM best LEFT JOIN (
          SELECT mid, string_agg(CAST(aid AS VARCHAR), '|' ORDER BY bo) AS ids,
                 string_agg('Person ' || aid, '|' ORDER BY bo) AS names, string_agg(ch, '|' ORDER BY bo) AS chs
          FROM role GROUP BY mid) ON mid = id""",
    "clean_through_csv": """
        WITH votes AS (SELECT l_orderkey, count(*) AS v FROM lineitem GROUP BY 1)
        SELECT CAST(id AS VARCHAR) AS id, title, CAST(year AS VARCHAR) AS year, CAST(did AS VARCHAR) AS director_id,
               dname AS director_name, genre, coalesce(c, '') AS "cast"
        FROM movie JOIN votes ON id = l_orderkey LEFT JOIN (
          SELECT mid, string_agg(aid || ' as ' || ch, '|' ORDER BY bo) AS c FROM role GROUP BY mid) ON mid = id
        WHERE v >= 4 AND id % 97 <> 0""",
    "clean_top_cast": "SELECT mid AS movie_id, bo AS billing_order, aid AS actor_id, pid AS part_id FROM role",
    "clean_crew_json": """SELECT id AS movie_id, CAST(did AS VARCHAR) AS director_id, dname AS director_name
        FROM movie WHERE id % 97 <> 0""",
    "lift_triples": """
        SELECT iri || substr(p, length(short) + 2) AS p, count(*) AS triples, count(*) FILTER (WHERE kind = 'iri') AS iris,
               count(*) FILTER (WHERE lang <> '') AS tagged
        FROM tri JOIN prefix ON split_part(p, ':', 1) = short GROUP BY 1""",
    "lift_dimensions": """
        SELECT label, trim(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
               trim(regexp_replace(lower(label), '[^a-z0-9]+', '_', 'g'), '_') AS underscored
        FROM (SELECT p_name AS label FROM part UNION SELECT p_brand FROM part UNION SELECT o_orderpriority FROM orders)""",
    "lift_dimension_nodes": "SELECT node AS s, label AS o, 'en' AS o_lang FROM dimension",
    "roles_disambiguated": "SELECT mid AS movie_id, aid AS actor_id, bo AS billing_order, role FROM roled",
    "role_labels": """SELECT mid AS movie_id, bo AS billing_order, 'Person ' || aid
        || CASE WHEN ch = '' THEN '' ELSE ' as ' || ch END || ' in Order ' || mid AS label FROM role""",
    "cast_alignment_quarantine": """
        SELECT mid AS id, count(*) AS n_ids, count(*) AS n_names,
               count(*) - 1 AS n_characters
        FROM role WHERE mid % 89 = 0 GROUP BY mid
        HAVING count(*) > 1 AND string_agg(CASE WHEN ch = '' THEN NULL ELSE ch END, '|') IS NOT NULL
           AND NOT (count(*) = 2 AND min(CASE WHEN bo = 1 THEN ch END) = '')""",
    "cast_unnested": """
        SELECT mid AS movie_id, bo AS billing_order, CAST(aid AS VARCHAR) AS actor_id, 'Person ' || aid AS actor_name,
               CASE WHEN mid % 89 = 0 THEN '' ELSE ch END AS character, role
        FROM roled
        WHERE mid % 89 <> 0 OR mid IN (
          SELECT mid FROM role WHERE mid % 89 = 0 GROUP BY mid
          HAVING count(*) = 1 OR (count(*) = 2 AND min(CASE WHEN bo = 1 THEN ch END) = ''))""",
    "bgp_star": f"""SELECT s AS movie, title, year FROM node WHERE g = '{O}genre_1_urgent'""",
    "bgp_path": """SELECT s AS movie, role, 'Person ' || aid AS actor FROM node JOIN rolenode ON s = m
        WHERE dname = 'Person 9' AND bo = 1""",
    "bgp_optional": """SELECT role, bo AS "order", nullif(ch, '') AS character FROM roled WHERE mid = 42""",
    "bgp_negation": "SELECT DISTINCT d AS p FROM node WHERE d NOT IN (SELECT a FROM rolenode)",
    "ask_exists": "SELECT count(*) > 0 AS answer FROM role WHERE mid = 42",
    "construct_pairs": f"""SELECT DISTINCT d AS s, '{O}worksWith' AS p, a AS o FROM node JOIN rolenode ON s = m""",
    "describe_movie": """
        SELECT s, iri || substr(p, length(short) + 2) AS p, o, kind AS o_kind,
               CASE WHEN kind = 'iri' OR lang <> '' THEN ''
                    WHEN p IN ('ont:releaseYear', 'ont:billingOrder') THEN 'http://www.w3.org/2001/XMLSchema#integer'
                    ELSE 'http://www.w3.org/2001/XMLSchema#string' END AS o_dt, lang AS o_lang
        FROM tri JOIN prefix ON split_part(p, ':', 1) = short WHERE s = 'http://kg.example/resource/movie/42'""",
    "ntriples_roundtrip": """
        SELECT iri || substr(p, length(short) + 2) AS p, kind AS o_kind, count(*) AS triples,
               CAST(sum(length(o)) AS BIGINT) AS chars,
               CASE WHEN kind = 'iri' OR p = 'rdfs:label' THEN ''
                    WHEN p IN ('ont:releaseYear', 'ont:billingOrder') THEN 'http://www.w3.org/2001/XMLSchema#integer'
                    ELSE 'http://www.w3.org/2001/XMLSchema#string' END AS datatype
        FROM tri JOIN prefix ON split_part(p, ':', 1) = short GROUP BY tri.p, iri, short, kind""",
    "link_ids": "SELECT 'http://kg.example/resource/person/' || k AS uri, item, article AS article_name FROM plinked",
    "link_candidates": "SELECT item, cand AS candidate FROM pcand",
    "link_choice": "SELECT item, res AS resource FROM pchoice",
    "link_report": "SELECT * FROM report",
    "link_report_columns": """SELECT count(*) AS kind, count(*) AS uri, count(*) AS label,
        count(nullif(wikidata, '')) AS wikidata, count(nullif(dbpedia, '')) AS dbpedia FROM report""",
    "link_coverage": """SELECT kind, count(*) AS resources, count(nullif(wikidata, '')) AS wikidata,
        count(nullif(dbpedia, '')) AS dbpedia FROM report GROUP BY kind""",
    "link_gate": """
        SELECT *, graph_wikidata = report_wikidata AND graph_dbpedia = report_dbpedia AS agree FROM (
          SELECT count(nullif(wikidata, '')) FILTER (WHERE there) AS graph_wikidata, count(nullif(wikidata, '')) AS report_wikidata,
                 count(nullif(dbpedia, '')) FILTER (WHERE there) AS graph_dbpedia, count(nullif(dbpedia, '')) AS report_dbpedia
          FROM (SELECT *, kind = 'person' OR CAST(split_part(label, ' ', 2) AS BIGINT) % 41 <> 0 AS there FROM report))""",
    "link_sample": """
        WITH firsts AS (
          SELECT k, arg_min(mid, 'http://kg.example/resource/movie/' || mid) AS mid, role FROM (
            SELECT did AS k, id AS mid, 'director' AS role FROM movie
            UNION ALL SELECT aid, mid, 'actor' FROM role WHERE aid NOT IN (SELECT did FROM movie)) GROUP BY k, role)
        SELECT kind, uri, label,
               CASE WHEN kind = 'movie' THEN m.year || ', directed by ' || m.dname
                    ELSE f.role || ' of ' || fm.title || ' (' || fm.year || ')' END AS local_facts, wikidata, dbpedia
        FROM sampled LEFT JOIN movie m ON kind = 'movie' AND m.title = label
             LEFT JOIN firsts f ON kind = 'person' AND label = 'Person ' || f.k LEFT JOIN movie fm ON fm.id = f.mid""",
    "link_precision": """
        SELECT target, count(*) AS checked, count(*) FILTER (WHERE correct) AS correct,
               count(*) FILTER (WHERE correct) / count(*) AS "precision"
        FROM (SELECT unnest(['wikidata', 'dbpedia']) AS target, unnest([wikidata, dbpedia]) AS iri,
                     md5(uri)[1] <> '0' AS correct FROM sampled) WHERE iri <> '' GROUP BY target""",
    "link_audit": """
        SELECT kind, CASE WHEN kind = 'person' THEN 'not found'
                          WHEN CAST(regexp_extract(dbpedia, '[0-9]+$') AS BIGINT) % 20 = 0 THEN 'redirect with label'
                          ELSE 'found' END AS outcome, count(*) AS links
        FROM report WHERE dbpedia <> '' AND kind = 'movie' GROUP BY ALL
        UNION ALL SELECT 'person', 'not found', count(*) FROM report WHERE dbpedia <> '' AND kind = 'person'""",
    "link_report_csv": "SELECT * FROM report",
    "link_gate_written": """
        SELECT count(*) FILTER (WHERE wikidata <> '') AS graph_wikidata, count(*) FILTER (WHERE wikidata <> '') AS report_wikidata,
               count(*) FILTER (WHERE dbpedia <> '') AS graph_dbpedia, count(*) FILTER (WHERE dbpedia <> '') AS report_dbpedia,
               true AS agree FROM report""",
    "graph_merge": """
        SELECT iri || substr(p, length(short) + 2) AS p, count(*) AS triples, count(DISTINCT s) AS subjects
        FROM tri JOIN prefix ON split_part(p, ':', 1) = short
        WHERE p IN ('foaf:name', 'dbo:director', 'rdf:type') GROUP BY 1""",
    "awards": "SELECT 'http://kg.example/resource/person/' || k AS person FROM holders",
    "award_coverage": "SELECT (SELECT count(*) FROM holders) AS holders, (SELECT count(*) FROM plinked) AS linked",
    "rule_equivalent": f"""SELECT '{O}Movie' AS class, count(*) AS members FROM movie
        UNION ALL SELECT '{O}Person', count(*) FROM people""",
    "rule_subclass": "SELECT class, count(*) AS members FROM closed WHERE class <> '" + O + "Award' GROUP BY class",
    "rule_domain_range": f"""
        SELECT '{O}Movie' AS class, count(*) AS members FROM movie UNION ALL
        SELECT '{O}' || class, count(*) FROM dimension GROUP BY class UNION ALL
        SELECT '{O}Director', count(DISTINCT did) FROM movie UNION ALL
        SELECT '{O}Actor', count(DISTINCT aid) FROM role UNION ALL SELECT '{O}CastRole', count(*) FROM role""",
    "rule_has_value": f"""SELECT CASE genre WHEN '1-URGENT' THEN '{O}ActionMovie' ELSE '{O}ComedyMovie' END AS class,
        count(*) AS members FROM movie WHERE genre IN ('1-URGENT', '5-LOW') GROUP BY 1""",
    "rule_has_value_triples": """SELECT 0::BIGINT AS "impliedOnly",
        count(*) FILTER (WHERE genre NOT IN ('1-URGENT', '5-LOW')) AS "saidOnly" FROM movie""",
    "rule_award_winning": """SELECT 'http://kg.example/resource/person/' || k AS s FROM holders
        WHERE k IN (SELECT did FROM movie)""",
    "rule_chain_starring": "SELECT DISTINCT m AS s, a AS o FROM rolenode",
    "rule_inverse": f"""
        SELECT '{O}hasCastRole' AS p, count(*) AS triples, count(DISTINCT m) AS subjects FROM rolenode
        UNION ALL SELECT '{O}roleInMovie', count(*), count(DISTINCT role) FROM rolenode""",
    "rule_functional": """
        WITH v AS (SELECT DISTINCT l_orderkey, l_linenumber, 'http://kg.example/resource/person/' || l_suppkey AS a
                   FROM lineitem),
        w AS (SELECT *, min(a) OVER (PARTITION BY l_orderkey, l_linenumber) AS least FROM v)
        SELECT DISTINCT least AS s, 'http://www.w3.org/2002/07/owl#sameAs' AS p, a AS o FROM w WHERE a <> least""",
    "rule_functional_clash": f"""
        SELECT 'http://kg.example/resource/role/' || mid || '-' || aid AS s, '{O}billingOrder' AS p,
               count(DISTINCT bo) AS n_values FROM role GROUP BY mid, aid HAVING count(DISTINCT bo) > 1""",
    "rule_actor_director": "SELECT d AS s FROM acting",
    "rule_disjoint": f"""
        SELECT 'http://kg.example/resource/movie/' || l_orderkey AS s, '{O}ComedyMovie' AS left_class,
               '{O}ActionMovie' AS right_class
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
        HAVING bool_or(p_type = 'PROMO') AND bool_or(p_type = 'ECONOMY')""",
    "rule_same_as": "SELECT size, count(*) AS clusters FROM clusters GROUP BY size",
    "rule_alias_counts": f"""
        WITH m AS (SELECT s, class FROM reported)
        SELECT class, count(*) AS members, CAST(sum(coalesce(size, 1)) AS BIGINT) AS with_aliases
        FROM m LEFT JOIN clusters ON s = uri GROUP BY class""",
    "rule_agreement": """
        SELECT count(*) FILTER (WHERE mid % 19 = 0 AND mid % 17 <> 0) AS "starringWithoutRole",
               count(*) FILTER (WHERE mid % 17 = 0 AND mid % 19 <> 0) AS "roleWithoutStarring",
               count(*) FILTER (WHERE (mid % 19 = 0) <> (mid % 17 = 0)) = 0 AS agree
        FROM (SELECT DISTINCT mid, aid FROM role)""",
    "rule_members": "SELECT class, s FROM reported",
    "rule_facts": """
        SELECT 'http://kg.example/ontology/hasCastRole' AS p, count(*) AS triples FROM roled WHERE mid % 19 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'http://dbpedia.org/ontology/starring', count(*) FROM (SELECT DISTINCT mid, aid FROM role WHERE mid % 17 = 0)
        HAVING count(*) > 0""",
    "rule_closure": f"""
        SELECT class, count(*) AS members FROM (
          SELECT s, class FROM closed
          UNION SELECT s, CASE genre WHEN '1-URGENT' THEN '{O}ActionMovie' ELSE '{O}ComedyMovie' END
                FROM node WHERE genre IN ('1-URGENT', '5-LOW')
          UNION SELECT d, '{O}ActorDirector' FROM acting
          UNION SELECT 'http://kg.example/resource/person/' || k, '{O}AwardWinningDirector' FROM holders
                WHERE k IN (SELECT did FROM movie)) GROUP BY class""",
    "bundle_with_bad_record": f"""
        WITH counted AS (SELECT class, count(*) AS members FROM (
          SELECT s, class FROM closed
          UNION SELECT s, CASE genre WHEN '1-URGENT' THEN '{O}ActionMovie' ELSE '{O}ComedyMovie' END
                FROM node WHERE genre IN ('1-URGENT', '5-LOW')
          UNION SELECT d, '{O}ActorDirector' FROM acting
          UNION SELECT 'http://kg.example/resource/person/' || k, '{O}AwardWinningDirector' FROM holders
                WHERE k IN (SELECT did FROM movie)) GROUP BY class),
        steps AS (SELECT * FROM (VALUES ('first', 0), ('with the bad record', 1), ('mended', 0)) x(step, bad)),
        more AS (SELECT * FROM (VALUES ('http://schema.org/Movie'), ('{O}Movie'), ('{O}ActionMovie'), ('{O}ComedyMovie')) x(class))
        SELECT step, class, members + CASE WHEN class IN (SELECT class FROM more) THEN bad ELSE 0 END AS members
        FROM counted, steps
        UNION ALL SELECT step, 'http://www.w3.org/2002/07/owl#Nothing', bad FROM steps WHERE bad > 0""",
    "rule_closure_equal": f"""
        WITH RECURSIVE {{NAMES}},
        acts AS (SELECT m, a FROM rolenode UNION SELECT m, a FROM lines),
        people2 AS (SELECT s, class FROM closed WHERE class LIKE '%/Person' OR class LIKE '%/Director' OR class LIKE '%/Actor'
          UNION SELECT a, '{O}' || c FROM lines, (VALUES ('Actor'), ('Person')) x(c)
          UNION SELECT a, 'http://xmlns.com/foaf/0.1/Person' FROM lines),
        directs AS (SELECT DISTINCT s AS m, coalesce(cluster, d) AS d FROM node LEFT JOIN named ON d = name),
        starring AS (SELECT DISTINCT m, coalesce(cluster, a) AS a FROM acts LEFT JOIN named ON a = name)
        SELECT class, count(*) AS members FROM (
          SELECT coalesce(cluster, s) AS s, class FROM people2 LEFT JOIN named ON s = name
          UNION SELECT s, class FROM closed WHERE NOT (class LIKE '%/Person' OR class LIKE '%/Director' OR class LIKE '%/Actor')
          UNION SELECT s, CASE genre WHEN '1-URGENT' THEN '{O}ActionMovie' ELSE '{O}ComedyMovie' END
                FROM node WHERE genre IN ('1-URGENT', '5-LOW')
          UNION SELECT line, '{O}CastRole' FROM lines
          UNION SELECT d, '{O}ActorDirector' FROM directs JOIN starring ON directs.m = starring.m AND d = a
          UNION SELECT coalesce(cluster, p), '{O}AwardWinningDirector' FROM (
                  SELECT 'http://kg.example/resource/person/' || k AS p FROM holders) LEFT JOIN named ON p = name
                WHERE coalesce(cluster, p) IN (SELECT d FROM directs)) GROUP BY class""",
    "rule_equal_names": "WITH RECURSIVE {NAMES} SELECT name AS node, cluster FROM named",
    "rule_explain": f"""
        SELECT DISTINCT '{O}ComedyMovie' AS left_class, '{O}ActionMovie' AS right_class,
          'http://kg.example/resource/movie/' || l_orderkey AS s, '{O}hasGenre' AS p, '{O}genre_' || lower(p_type) AS o
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE p_type IN ('PROMO', 'ECONOMY') AND l_orderkey IN (
          SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IN ('PROMO', 'ECONOMY')
          GROUP BY l_orderkey HAVING count(DISTINCT p_type) = 2)""",
    "void_classes": "SELECT o AS class, count(*) AS entities FROM pub WHERE p = 'rdf:type' GROUP BY o",
    "void_properties": """SELECT iri || substr(p, length(short) + 2) AS property, count(*) AS triples
        FROM pub JOIN prefix ON split_part(p, ':', 1) = short GROUP BY 1""",
    "void_linksets": """SELECT CASE WHEN o LIKE '%wikidata%' THEN 'wikidata.org' ELSE 'dbpedia.org' END AS target,
        count(*) AS triples FROM sameas GROUP BY 1""",
    "void_subjects": """
        SELECT CAST(sum(files) AS BIGINT) AS subjects_per_file_sum, count(*) AS subjects_merged,
               CAST(sum(files) AS BIGINT) AS entities_per_file_sum, count(*) AS entities_merged
        FROM (SELECT s, count(DISTINCT g) AS files FROM pub GROUP BY s)""",
    "void_dataset": f"""
        WITH n AS (
          SELECT (SELECT count(*) FROM pub) AS triples, (SELECT count(DISTINCT (g, s)) FROM pub) AS subjects,
                 (SELECT count(DISTINCT o) FROM pub WHERE p = 'rdf:type') AS classes,
                 (SELECT count(DISTINCT p) FROM pub) AS properties, (SELECT count(*) FROM movie) AS movies),
        cls AS (SELECT o AS class, count(*) AS n, '_:b' || md5('class' || chr(31) || o) AS b FROM pub
                WHERE p = 'rdf:type' GROUP BY o),
        prop AS (SELECT iri || substr(p, length(short) + 2) AS property, count(*) AS n,
                        '_:b' || md5('property' || chr(31) || iri || substr(p, length(short) + 2)) AS b
                 FROM pub JOIN prefix ON split_part(p, ':', 1) = short GROUP BY ALL),
        link AS (SELECT CASE WHEN o LIKE '%wikidata%' THEN 'wikidata.org' ELSE 'dbpedia.org' END AS target, count(*) AS n
                 FROM sameas GROUP BY 1),
        voc AS (SELECT short, iri FROM prefix UNION ALL SELECT * FROM (VALUES ('void', 'http://rdfs.org/ns/void#'),
                  ('dct', 'http://purl.org/dc/terms/'), ('dcat', 'http://www.w3.org/ns/dcat#'),
                  ('prov', 'http://www.w3.org/ns/prov#')) x(short, iri)),
        -- objects: '#' local, 'iri' absolute, 'lit' text, 'int' and 'day' typed, else the language
        said(s, p, o, kind) AS (
          SELECT * FROM (VALUES
            ('#dataset', 'rdf:type', 'http://rdfs.org/ns/void#Dataset', 'iri'), ('#dataset', 'rdf:type', 'http://www.w3.org/ns/dcat#Dataset', 'iri'),
            ('#dataset', 'dct:title', 'Orders told as films', 'en'),
            ('#dataset', 'dct:license', 'https://creativecommons.org/licenses/by/4.0/', 'iri'),
            ('#dataset', 'dct:publisher', 'keepers', '#'), ('#dataset', 'dct:source', 'order-tables', '#'),
            ('#dataset', 'dcat:keyword', 'order tables', 'en'), ('#dataset', 'void:uriSpace', 'http://kg.example/resource/', 'lit'),
            ('#dataset', 'void:exampleResource', 'http://kg.example/resource/movie/7', 'iri'),
            ('#dataset', 'void:vocabulary', 'http://kg.example/ontology/', 'iri'), ('#dataset', 'void:vocabulary', 'http://xmlns.com/foaf/0.1/', 'iri'),
            ('#dataset', 'void:vocabulary', 'http://schema.org/', 'iri'), ('#dataset', 'void:vocabulary', 'http://dbpedia.org/ontology/', 'iri'),
            ('#dataset', 'void:vocabulary', 'http://purl.org/dc/elements/1.1/', 'iri'),
            ('#keepers', 'rdf:type', 'http://xmlns.com/foaf/0.1/Organization', 'iri'),
            ('#keepers', 'foaf:name', 'Keepers of the order tables', 'lit'),
            ('#order-tables', 'rdf:type', 'http://www.w3.org/ns/dcat#Dataset', 'iri'),
            ('#order-tables', 'dct:title', 'Orders, lineitems, customers, suppliers and parts', 'en'),
            ('https://www.wikidata.org/', 'dct:license', 'https://creativecommons.org/publicdomain/zero/1.0/', 'iri'),
            ('https://dbpedia.org/', 'dct:license', 'https://creativecommons.org/licenses/by-sa/3.0/', 'iri'),
            ('#dataset', 'prov:wasGeneratedBy', 'run', '#'), ('#run', 'rdf:type', 'http://www.w3.org/ns/prov#Activity', 'iri'),
            ('#run', 'prov:used', 'order-tables', '#'),
            ('#dataset', 'dct:created', '2026-01-01', 'day'), ('#dataset', 'dct:modified', '2026-01-01', 'day'),
            ('#links-wikidata.org', 'void:objectsTarget', 'https://www.wikidata.org/', 'iri'),
            ('#links-dbpedia.org', 'void:objectsTarget', 'https://dbpedia.org/', 'iri')) x(s, p, o, kind)
          UNION ALL SELECT '#dataset', 'void:subset', 'links-' || target, '#' FROM link
          UNION ALL SELECT '#links-' || target, 'rdf:type', 'http://rdfs.org/ns/void#Linkset', 'iri' FROM link
          UNION ALL SELECT '#links-' || target, 'void:linkPredicate', 'http://www.w3.org/2002/07/owl#sameAs', 'iri' FROM link
          UNION ALL SELECT '#links-' || target, 'void:subjectsTarget', 'dataset', '#' FROM link
          UNION ALL SELECT '#links-' || target, 'void:triples', CAST(n AS VARCHAR), 'int' FROM link
          UNION ALL SELECT '#dataset', 'void:triples', CAST(triples AS VARCHAR), 'int' FROM n
          UNION ALL SELECT '#dataset', 'void:entities', CAST(subjects AS VARCHAR), 'int' FROM n
          UNION ALL SELECT '#dataset', 'void:distinctSubjects', CAST(subjects AS VARCHAR), 'int' FROM n
          UNION ALL SELECT '#dataset', 'void:classes', CAST(classes AS VARCHAR), 'int' FROM n
          UNION ALL SELECT '#dataset', 'void:properties', CAST(properties AS VARCHAR), 'int' FROM n
          UNION ALL SELECT '#dataset', 'dct:description', 'Graph of ' || movies || ' movies with their people, roles and places.', 'en' FROM n
          UNION ALL SELECT '#dataset', 'dct:description', 'Đồ thị gồm ' || movies || ' phim, kèm con người, vai diễn và nơi chốn.', 'vi' FROM n
          UNION ALL SELECT '#dataset', 'void:classPartition', b, 'bnode' FROM cls
          UNION ALL SELECT b, 'void:class', class, 'iri' FROM cls
          UNION ALL SELECT b, 'void:entities', CAST(n AS VARCHAR), 'int' FROM cls
          UNION ALL SELECT '#dataset', 'void:propertyPartition', b, 'bnode' FROM prop
          UNION ALL SELECT b, 'void:property', property, 'iri' FROM prop
          UNION ALL SELECT b, 'void:triples', CAST(n AS VARCHAR), 'int' FROM prop
          UNION ALL SELECT '#dataset', 'dcat:distribution', 'file-' || g, '#' FROM pubfile
          UNION ALL SELECT '#file-' || g, 'rdf:type', 'http://www.w3.org/ns/dcat#Distribution', 'iri' FROM pubfile
          UNION ALL SELECT '#file-' || g, 'dct:title', g, 'lit' FROM pubfile
          UNION ALL SELECT '#file-' || g, 'dct:format', 'application/n-triples', 'lit' FROM pubfile
          UNION ALL SELECT '#file-' || g, 'dcat:mediaType', 'https://www.iana.org/assignments/media-types/application/n-triples', 'iri' FROM pubfile
          UNION ALL SELECT '#file-' || g, 'dcat:accessURL', 'http://kg.example/films/' || g, 'iri' FROM pubfile
          UNION ALL SELECT '#file-' || g, 'dcat:downloadURL', 'http://kg.example/films/raw/' || g, 'iri' FROM pubfile
          UNION ALL SELECT '#file-' || g, 'dcat:byteSize', CAST(bytes AS VARCHAR), 'size' FROM pubfile
          UNION ALL SELECT '#file-' || g, 'dct:license', 'https://creativecommons.org/licenses/by/4.0/', 'iri' FROM pubfile
          UNION ALL SELECT '#file-' || g, 'void:triples', CAST(n AS VARCHAR), 'int' FROM pubfile)
        SELECT CASE WHEN s[1] = '#' THEN 'http://kg.example/metadata/' || s[2:] ELSE s END AS s,
               iri || substr(p, length(short) + 2) AS p,
               CASE WHEN kind = '#' THEN 'http://kg.example/metadata/' || o ELSE o END AS o,
               CASE kind WHEN '#' THEN 'iri' WHEN 'iri' THEN 'iri' WHEN 'bnode' THEN 'bnode' ELSE 'lit' END AS o_kind,
               CASE kind WHEN 'lit' THEN '{XS}string' WHEN 'int' THEN '{XS}integer' WHEN 'day' THEN '{XS}date'
                         WHEN 'size' THEN '{XS}nonNegativeInteger' ELSE '' END AS o_dt,
               CASE WHEN kind IN ('en', 'vi') THEN kind ELSE '' END AS o_lang
        FROM said JOIN voc ON split_part(p, ':', 1) = short""",
    "void_republished": """
        WITH part AS (SELECT p <> 'rdfs:label' AS early, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes
                      FROM publine WHERE g = 'awards' GROUP BY 1)
        SELECT 1::BIGINT AS version, 'awards' AS g, n AS triples, bytes, '2026-01-01' AS created, '2026-01-01' AS modified,
               (SELECT CAST(sum(n) AS BIGINT) FROM part) AS triples_read FROM part WHERE early
        UNION ALL SELECT 2, 'awards', CAST(sum(n) AS BIGINT), CAST(sum(bytes) AS BIGINT), '2026-01-01', '2026-02-01',
               CAST(sum(n) AS BIGINT) FROM part""",
    "bundle": """
        SELECT CASE WHEN short IS NULL THEN p ELSE iri || substr(p, length(short) + 2) END AS p,
               CAST(sum(n) AS BIGINT) AS triples
        FROM (SELECT p, count(*) AS n FROM pub GROUP BY p UNION ALL SELECT p, n FROM (VALUES
          ('rdf:type', 13 + 9 + 3 + 3 + 4 + 2 - 2 + 1), ('rdfs:label', 13 + 12 + 2 - 2),
          ('owl:equivalentClass', 5), ('rdfs:subClassOf', 4), ('owl:disjointWith', 1), ('owl:inverseOf', 1),
          ('rdfs:domain', 12), ('rdfs:range', 12), ('owl:onProperty', 3), ('owl:hasValue', 2),
          ('owl:someValuesFrom', 1), ('owl:intersectionOf', 1), ('rdf:first', 4), ('rdf:rest', 4),
          ('owl:propertyChainAxiom', 1), ('rdfs:seeAlso', 2), ('rdfs:comment', 1)) x(p, n))
        LEFT JOIN prefix ON split_part(p, ':', 1) = short GROUP BY 1""",
}


def _needed(sql: str) -> set[str]:
    """Views a statement names, with those they name in turn."""
    named = {v for v in VIEWS if re.search(rf"\b{v}\b", sql)}
    return named.union(*(_needed(VIEWS[v]) for v in named)) if named else named


def checks() -> dict[str, str]:
    out = {}
    for name, sql in CHECKS.items():
        sql = sql.replace("{NAMES}", NAMES)
        needed = _needed(sql)
        parts = [f"{v} AS ({body})" for v, body in VIEWS.items() if v in needed]
        body = sql.strip()
        if body.startswith("WITH RECURSIVE "):
            out[name] = "WITH RECURSIVE " + ", ".join([*parts, body.removeprefix("WITH RECURSIVE ")])
        elif body.startswith("WITH "):
            body = body[5:]
            out[name] = "WITH " + ", ".join([*parts, body])
        else:
            out[name] = ("WITH " + ", ".join(parts) + " " if parts else "") + body
    return out
