"""The four applications, assembled from the operators. Every stage is a function of its own, so a
caller may store any stage and go on from there."""
