"""fluxgrain.sources"""
