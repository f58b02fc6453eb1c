"""DataFrame -> DataFrame operators.

harmonise  type harmonisation of text period files
union      stacking periods by name with provenance
funnel     ordered eligibility rules and the exclusion funnel
labels     code dictionaries
audit      cross-tabs, missing values, repeated keys, row-count checks
quantiles  exact (skew-safe distributed selection) and approximate quantiles
stats      summaries, medians, frequencies, histograms, correlation, samples, modes
segment    scaling, KMeans sweep, silhouette, cluster profiles
regress    split, feature stages, ridge / forest sweeps, metrics, holdout
diagnose   residuals and error tables
"""
