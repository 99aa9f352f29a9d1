"""Jobs: merge a drop, standardize, denormalise, model, marts, views."""
