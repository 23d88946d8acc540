"""Queries: population maximum, labels, normalised features, statistics, models."""

from pyspark.sql import functions as F

from rolepulse.layouts import MODEL_FEATURES, REPLAY_ORDER, SGD_ITERATIONS
from rolepulse.plans import activity as A
from rolepulse.plans import churn as C
from rolepulse.plans import training as T
from rolepulse.registry.base import AS_OF, cohort_of, flow_events, query, sql
from rolepulse.session import materialise

FEATURES = ", ".join(MODEL_FEATURES)
_SOURCES = {"": "clean", "_replay": "replayed"}


def _roles(spark, d, replay):
    cohort = cohort_of(spark, d)
    roles = A.role_activity(flow_events(spark, d, *REPLAY_ORDER), AS_OF, replay, cohort=cohort)
    return roles, C.global_max(roles, cohort.first_day()), cohort


def _features(spark, d, replay):
    return C.labelled_features(flow_events(spark, d, *REPLAY_ORDER), AS_OF, replay, cohort=cohort_of(spark, d))


def _stored_features(spark, d, replay):
    """Features kept as a table: statistics and ten training passes read it instead of redoing the job."""
    return materialise(_features(spark, d, replay), "features")


def _rounded(df, *keep):
    return df.select(*keep, *[F.round(c, 6).alias(c) for c in df.columns if c not in keep])


def _rounded_sql(names=MODEL_FEATURES):
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _sgd_sql(feats: str, model: str) -> str:
    """Weights after each step as one table per step."""
    n = MODEL_FEATURES
    parts = [f"w0 AS MATERIALIZED (SELECT {', '.join(f'0.0::DOUBLE AS w{i}' for i in range(len(n)))}, false AS done)"]
    margin = " + ".join(f"w{i} * {c}" for i, c in enumerate(n))
    pull = (f"1 / (1 + exp(-({margin}))) - label" if model == "logistic"
            else f"CASE WHEN (2 * label - 1) * ({margin}) < 1 THEN 1 - 2 * label ELSE 0 END")
    for t in range(1, SGD_ITERATIONS + 1):
        moved = " + ".join(f"(v{i} - w{i}) ** 2" for i in range(len(n)))
        size = " + ".join(f"v{i} ** 2" for i in range(len(n)))
        stop = f"sqrt({moved}) < 0.001 * greatest(sqrt({size}), 1.0)" if t > 1 else "false"
        parts.append(f"""g{t} AS MATERIALIZED (
            SELECT count(*) AS n, {', '.join(f'sum(p * {c}) AS g{i}' for i, c in enumerate(n))}
            FROM (SELECT f.*, {pull} AS p FROM {feats} f, w{t - 1}))""")
        parts.append(f"""w{t} AS MATERIALIZED (
            SELECT {', '.join(f'CASE WHEN done THEN w{i} ELSE v{i} END AS w{i}' for i in range(len(n)))},
                   done OR {stop} AS done
            FROM (SELECT w.*, {', '.join(f'w{i} * (1 - 0.01 / sqrt({t})) - g{i} / n / sqrt({t}) AS v{i}'
                                         for i in range(len(n)))} FROM w{t - 1} w, g{t}))""")
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(w{i}, 6) AS {model} FROM w{SGD_ITERATIONS}" for i, c in enumerate(n))
    return "WITH " + ", ".join(parts) + " " + rows


def _register(tag: str, src: str) -> None:
    replay = tag == "_replay"

    @query(f"global_max{tag}", sql(f"SELECT {FEATURES}, ts FROM top{tag}", f"top{tag}"))
    def global_max(spark, d):
        return _roles(spark, d, replay)[1]

    @query(f"churn_label{tag}", sql(f"SELECT roleid, ts, max_ts, is_lost FROM labels_{src}", f"labels_{src}"))
    def churn_label(spark, d):
        roles, top, _ = _roles(spark, d, replay)
        return C.churn_label(roles.select("roleid", "ts"), top)

    @query(f"normalise_features{tag}", sql(
        f"SELECT roleid, is_lost, label, {_rounded_sql()} FROM feats_{src}", f"feats_{src}"))
    def normalise_features(spark, d):
        return _rounded(_features(spark, d, replay), "roleid", "is_lost", "label")

    @query(f"lost_rate{tag}", sql(f"""
        SELECT round(avg(CAST(is_lost AS INTEGER)), 6) AS lost_rate, count(*) AS active_roles,
               (SELECT count(*) FROM cohort) AS cohort_roles FROM labels_{src}""", f"labels_{src}", "cohort"))
    def lost_rate(spark, d):
        roles, top, cohort = _roles(spark, d, replay)
        rate = C.lost_rate(C.churn_label(roles.select("roleid", "ts"), top), cohort.roles)
        return _rounded(rate, "active_roles", "cohort_roles")

    stats = " UNION ALL ".join(f"""
        SELECT '{n}' AS feature, round(avg({n}) FILTER (WHERE is_lost), 6) AS lost_mean,
               round(stddev_pop({n}) FILTER (WHERE is_lost), 6) AS lost_std,
               round(avg({n}) FILTER (WHERE NOT is_lost), 6) AS unlost_mean,
               round(stddev_pop({n}) FILTER (WHERE NOT is_lost), 6) AS unlost_std FROM feats_{src}"""
                                 for n in MODEL_FEATURES)

    @query(f"class_feature_stats{tag}", sql(stats, f"feats_{src}"))
    def class_feature_stats(spark, d):
        return _rounded(C.class_feature_stats(_features(spark, d, replay), list(MODEL_FEATURES)), "feature")

    def weights(spark, d, *models):
        feats, names = _stored_features(spark, d, replay), list(MODEL_FEATURES)
        return _rounded(T.weights_table(feats, names, **T.train(feats, names, models)), "feature")

    def train_sql(model):
        return sql(f"SELECT * FROM ({_sgd_sql(f'feats_{src}', model)})", f"feats_{src}")

    query(f"train_svm{tag}", train_sql("svm"))(lambda spark, d: weights(spark, d, "svm"))
    query(f"train_logistic{tag}", train_sql("logistic"))(lambda spark, d: weights(spark, d, "logistic"))
    query(f"weights_report{tag}", sql(f"""
        SELECT a.feature, a.svm, b.logistic FROM ({_sgd_sql(f'feats_{src}', 'svm')}) a
        JOIN ({_sgd_sql(f'feats_{src}', 'logistic')}) b ON a.feature = b.feature""", f"feats_{src}"))(
        lambda spark, d: weights(spark, d, "svm", "logistic"))


for _tag, _src in _SOURCES.items():
    _register(_tag, _src)


@query("label_encode", sql("""
    SELECT roleid, CASE WHEN is_lost THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
           CASE WHEN is_lost THEN -1.0 ELSE 1.0 END::DOUBLE AS signed_label FROM labels_clean""", "labels_clean"))
def label_encode(spark, d):
    roles, top, _ = _roles(spark, d, False)
    labelled = C.churn_label(roles.select("roleid", "ts"), top)
    both = C.label_encode(C.label_encode(labelled), signed=True, name="signed_label")
    return both.select("roleid", "label", "signed_label")


@query("select_features", sql(f"SELECT roleid, {FEATURES} FROM clean", "clean"))
def select_features(spark, d):
    roles = A.role_activity(flow_events(spark, d, *REPLAY_ORDER), AS_OF, cohort=cohort_of(spark, d))
    return roles.select("roleid", *C.select_features(roles))


@query("normalise_cross_join", sql(
    "SELECT c.roleid, c.online_sum, t.online_sum AS max_online_sum, t.ts AS max_ts FROM clean c, top t", "clean", "top"))
def normalise_cross_join(spark, d):
    roles, top, _ = _roles(spark, d, False)
    return C.with_top(roles.select("roleid", "online_sum"), top, "online_sum", "ts")
